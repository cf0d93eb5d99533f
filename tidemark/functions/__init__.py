"""Column-level building blocks: aggregates, parsers, time helpers, payloads."""
