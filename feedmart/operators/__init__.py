"""DataFrame operators: top-n per group, exploration, quality checks."""
