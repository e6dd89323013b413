"""Models as plain functions from DataFrame to DataFrame, and the daily job that ties them together."""
