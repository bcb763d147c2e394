"""Whole jobs: cleaning a dataset, profiling it, building and loading the warehouse."""
