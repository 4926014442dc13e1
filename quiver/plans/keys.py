"""Row keys of any type, under names of their own inside a plan.

Every plan renames what it needs (row key, vector, group, query) to names
that start with two underscores, so that no input column clashes with the
engine's own, and gives the input's names and types back at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType


def quoted(name: str) -> Column:
    """The top-level column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


class RowKey:
    """One column, or several, that identify a row and order equal distances."""

    def __init__(self, df: DataFrame, columns: str | list[str], prefix: str = "__id"):
        self.names = [columns] if isinstance(columns, str) else list(columns)
        if not self.names:
            raise ValueError("empty key column list")
        self.types = [df.schema[n].dataType for n in self.names]
        self.inner = [f"{prefix}{i}" for i in range(len(self.names))]
        self.arrow = [to_arrow_type(t) for t in self.types]
        self.integral = len(self.names) == 1 and isinstance(self.types[0], IntegralType)

    def select(self) -> list[Column]:
        return [quoted(n).alias(a) for n, a in zip(self.names, self.inner)]

    def restore(self, names: list[str] | None = None) -> list[Column]:
        return [F.col(a).alias(n) for a, n in zip(self.inner, names or self.names)]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{a}` {t.simpleString()}" for a, t in zip(self.inner, self.types))

    def order(self) -> list[Column]:
        return [F.col(a).asc_nulls_first() for a in self.inner]

    def read(self, batch: pa.RecordBatch):
        """Comparable keys of a batch: integers, or keys that are built where they are asked for."""
        arrays = [batch.column(a) for a in self.inner]
        if self.integral and not arrays[0].null_count:
            return np.asarray(arrays[0].to_numpy(zero_copy_only=False), dtype=np.int64)
        return LazyKeys(arrays, np.arange(batch.num_rows))

    def write(self, keys: np.ndarray) -> list[pa.Array]:
        if keys.dtype != object:
            return [pa.array(keys, pa.int64()).cast(self.arrow[0])]
        return [pa.array([x[j][1] for x in keys], type=t) for j, t in enumerate(self.arrow)]


class LazyKeys:
    """Keys of a batch's rows: places until :meth:`values` builds them.

    Few of a batch's rows become candidates, and only theirs are built, as
    tuples that sort as Spark sorts (NULL first).
    """

    def __init__(self, arrays: list[pa.Array], places: np.ndarray):
        self.arrays, self.places = arrays, places

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, rows) -> "LazyKeys":
        return LazyKeys(self.arrays, self.places[rows])

    def values(self) -> np.ndarray:
        at = pa.array(self.places, pa.int64())
        out = np.empty(len(self.places), dtype=object)
        for i, row in enumerate(zip(*[a.take(at).to_pylist() for a in self.arrays])):
            out[i] = tuple((v is not None, v) for v in row)
        return out


def built(keys) -> np.ndarray:
    return keys.values() if isinstance(keys, LazyKeys) else keys


def as_objects(keys: np.ndarray) -> np.ndarray:
    """Integer keys in the form of nullable ones (a task may meet both)."""
    if keys.dtype == object:
        return keys
    out = np.empty(len(keys), dtype=object)
    for i, v in enumerate(keys.tolist()):
        out[i] = ((True, v),)
    return out
