"""Daily content-feed analytics on Spark: landing, raw tables, staging, marts, checks, exploration."""
