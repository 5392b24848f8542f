"""Registered queries: each runs the engine over the given tables and has SQL to compare with."""
