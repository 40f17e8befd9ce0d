"""Operators, grouped by topic; every one is DataFrame -> DataFrame."""

from sparkmine.operators import clustering, evaluate, fpm, itemsets, series, transform  # noqa: F401
