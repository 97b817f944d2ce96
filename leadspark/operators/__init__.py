"""Operators on DataFrames. Each returns a plan; only fits and bounded scalars run jobs."""
