"""Whole pipelines: the streaming and batch jobs, and the registered queries with their SQL counterparts."""
