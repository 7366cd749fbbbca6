"""Operators for large training-data pipelines. Nothing else in changelake imports this package."""
