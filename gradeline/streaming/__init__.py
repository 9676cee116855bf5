"""The streaming path into bronze and silver."""
