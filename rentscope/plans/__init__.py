"""Reusable plan shapes: saved tables, ordered blocks, exact percentiles, recency tiers."""
