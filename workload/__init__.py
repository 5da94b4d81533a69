"""The package's operators and jobs, run on the given tables."""
