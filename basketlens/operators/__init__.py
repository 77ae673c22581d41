"""Reusable DataFrame operators: ordering, dedupe, merge, quality, quantiles, regression."""
