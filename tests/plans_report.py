"""Regenerate PLANS.md: the physical plan of each main operator at sf0.1.

usage: python tests/plans_report.py [sf_dir]
"""
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
from quiver.plans.session import build_session
from quiver.plans.explain import plan_text
import __spark_entry__ as E
from quiver import search, search_groups, search_many, fractal_distance, radius_search, min_distance_to_set, refine_queries
from pyspark.sql import functions as F
spark = build_session("local[8]", shuffle_partitions=8)
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
emb = spark.read.parquet(f"{sf}/embeddings.parquet")
q = E.main_query()
qs = emb.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
cases = [
    ("S1 top-k, one query (`search`)", search(emb.filter("label = 3"), q, 10, id_col="vec_id"),
     "Filter pushed into the scan, only id + vector read, per-task top-k in MapInArrow, one merge; no exchange."),
    ("S1g top-k per group (`search_groups`)", search_groups(emb, q, "label", 5, id_col="vec_id"),
     "Per-task k per group, partial WindowGroupLimit, one shuffle on the group key, final limit."),
    ("S1m many queries, queries broadcast (`search_many`)", search_many(emb, qs, 10, id_col="vec_id", exact=True),
     "Query bank broadcast (measured); only candidates shuffle, on query_id."),
    ("S1m many queries, vectors broadcast", search_many(emb, qs, 10, id_col="vec_id", exact=True, broadcast_bytes=1, vector_broadcast_bytes=1 << 26),
     "Vector bank broadcast (measured); queries spread by hash; each task finishes its queries; no window."),
    ("R1 refine a query table (`refine_queries`)", refine_queries(emb, "embedding"),
     "Distinct queries with a map-side partial aggregate, then a round-robin spread AQE keeps, then the seeded search per task."),
    ("S3 score every row (`fractal_distance`)", fractal_distance(emb, q).select("vec_id", "dist"),
     "One ArrowEvalPython over the vector column; other columns stay in the JVM row."),
    ("S1r radius (`radius_search`)", radius_search(emb, q, 0.85, id_col="vec_id"),
     "Matches only, straight from the scan; no exchange."),
    ("V4 distance to a set (`min_distance_to_set`)", min_distance_to_set(emb, emb.filter("label = 0"), id_col="vec_id"),
     "Member set broadcast (measured); one pass, no exchange."),
]
out = ["# Physical plans (sf0.1, `explain(\"simple\")`)", "",
       "Generated by `quiver.plans.explain.plan_text`; the shapes are asserted in `tests/test_plans.py`.", ""]
for title, df, note in cases:
    text = plan_text(df, "simple")
    text = re.sub(r"file:/[^\]]*", "file:…", text)
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    lines = [l.rstrip() for l in text.splitlines() if l.strip() and not l.startswith("== ")]
    lines = [l if len(l) < 160 else l[:157] + "..." for l in lines]
    out += [f"## {title}", "", note, "", "```", *lines, "```", ""]
open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(out))
