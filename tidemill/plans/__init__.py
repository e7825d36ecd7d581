"""Pipelines and published queries."""
