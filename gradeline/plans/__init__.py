"""The steps from landed rows to graded forecasts."""
