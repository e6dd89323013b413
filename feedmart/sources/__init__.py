"""Landing files, raw tables and model tables."""
