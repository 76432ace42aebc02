"""Structured Streaming form of the core / niche file split (the only incremental step of the workload)."""
