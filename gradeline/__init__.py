"""Spark operators that take raw JSON pulls to graded rise / hold / fall forecasts."""
