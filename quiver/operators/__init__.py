"""Refinement, scoring, search, set distance and checks as Spark jobs."""
