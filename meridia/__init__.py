"""Spark operators for preparing, modelling and judging tabular time-series data.

Every operator takes DataFrames and returns DataFrames. Only values whose number is bounded by
classes, features, folds, candidates or trees come back to the driver; rows stay on the cluster.
"""

__version__ = "0.1.0"
