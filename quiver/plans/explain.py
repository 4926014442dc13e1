"""Plan inspection helpers (what ``explain`` prints, as a string)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of every file scan in the physical plan."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\n]*)\]", plan_text(df))


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of a physical operator name in the plan tree (not the details)."""
    tree = plan_text(df, "simple")
    return len(re.findall(rf"\b{re.escape(name)}\b", tree))
