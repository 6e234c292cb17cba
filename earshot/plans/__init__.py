"""Whole jobs and the registered query catalogue, composed from the operators."""
