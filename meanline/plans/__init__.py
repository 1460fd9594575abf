"""Spark ML pipelines, grids, cross-validation and the composite jobs."""
