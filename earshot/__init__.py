"""Recommendation analytics on Spark: index, split, train, recommend, search, score."""
