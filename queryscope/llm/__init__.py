"""Operators for large training-data pipelines; nothing else in queryscope imports this package."""
