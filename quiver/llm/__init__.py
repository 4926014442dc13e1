"""Operators for training-data pipelines.

Each operator has a module of its own; ``queries`` registers the thin query
forms and their oracle SQL.  Nothing else in the package imports this one.
"""
