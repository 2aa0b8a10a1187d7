"""Shared column expressions, the as-of clock and size-checked joins."""
