"""Reusable relational operators (cleaning, profiling, rollups, sequences,
ranking, thresholds, quality)."""
