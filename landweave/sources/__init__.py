"""Sinks of results: statistics, vector features, feature cubes, training rows."""
