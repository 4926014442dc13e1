"""quiver: nearest-vector search over Spark tables.

Cosine distance to a refined query point, computed as Spark jobs:
refinement of each distinct query (a seeded population search), scoring in
Arrow batches, top-k / per-group / radius selection with Spark's shuffle
and window operators, a SQL function, and streaming scoring.
"""

from .functions.sql import fractal_search, register
from .functions.tables import register_tables
from .functions.vectors import cosine_distance, feature_vector, valid_vector
from .operators.checks import (check_convergence, check_search_result, refinement_quality,
                               single_query_quality)
from .operators.pivots import pivot_search_many, pivot_search_report
from .operators.points import PointTable
from .operators.refine import (explore_queries, refine_queries, refine_with_ids,
                               refinement_report)
from .operators.search import (exact_search, fractal_distance, multi_probe_search,
                               radius_many, radius_search, search, search_groups, search_many,
                               search_top_k, with_payload)
from .operators.setdist import min_distance_to_set, refine_against_sets
from .operators.sfs import RefineOptions

__all__ = [
    "PointTable", "RefineOptions", "register", "register_tables", "fractal_search", "cosine_distance", "feature_vector",
    "valid_vector", "refine_queries", "refine_with_ids", "refinement_report", "explore_queries",
    "search", "exact_search", "search_groups", "radius_search", "radius_many", "fractal_distance",
    "search_many", "pivot_search_many", "pivot_search_report", "search_top_k", "multi_probe_search", "with_payload",
    "min_distance_to_set", "refine_against_sets", "check_convergence", "check_search_result",
    "refinement_quality", "single_query_quality",
]
