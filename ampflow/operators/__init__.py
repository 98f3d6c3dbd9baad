"""Reusable DataFrame operators: joins, exact quantiles, ranking, profiling, data-quality rules."""
