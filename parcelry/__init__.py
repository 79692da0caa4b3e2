"""Drift, training and scoring jobs for tabular price regression, on Spark."""
