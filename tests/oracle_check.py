"""Run queries() against oracle_sql() like the driver does (row count + values).

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from quiver.plans.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf)
        cols = sorted(df.columns)
        rows = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
        dt = time.time() - t0
        if name not in oracles:
            print(f"{name:24s} rows={len(rows):6d} (no oracle) {dt:6.2f}s")
            continue
        rel = con.sql(oracles[name])
        ocols = rel.columns
        if sorted(ocols) != cols:
            print(f"{name:24s} COLUMN MISMATCH spark={cols} oracle={sorted(ocols)}")
            bad += 1
            continue
        spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        mapping = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
                   "string": "VARCHAR", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}
        type_diff = {c: (spark_types[c], duck_types[c]) for c in cols
                     if mapping.get(spark_types[c], spark_types[c]) != duck_types[c]}
        if type_diff:
            print(f"{name:24s} TYPE MISMATCH {type_diff}")
        data = rel.fetchall()
        orows = sorted((tuple(norm(r[ocols.index(c)]) for c in cols) for r in data), key=repr)
        ok = rows == orows
        bad += not ok
        print(f"{name:24s} rows={len(rows):6d} oracle={len(orows):6d} {'OK' if ok else 'MISMATCH'} {dt:6.2f}s")
        if not ok:
            diff = [(a, b) for a, b in zip(rows, orows) if a != b][:3]
            print("   first diffs:", diff)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
