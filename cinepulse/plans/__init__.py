"""Runnable query plans: the registry, its DuckDB oracle SQL and the jobs."""
