"""Operators of a training-data pipeline (texts, conversations) on Spark.

Nothing outside this subpackage imports it. ``queries`` holds the registered
queries and their oracle SQL; each operator has a module of its own.
"""
