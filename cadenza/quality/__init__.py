"""Data-quality checks: families of predicates, named checks, outcome and publication gate."""
