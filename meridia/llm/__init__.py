"""Operators of a training-data pipeline: filters, formatting, classifiers, archives, deduplication, mixing."""
