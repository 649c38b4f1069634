"""Experiment analytics on Spark: events in, star schema, marts, statistics and a verdict out."""
