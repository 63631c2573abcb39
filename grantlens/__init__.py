"""Spark-native analytics over granted-patent data and similar entity-activity records."""

from grantlens.star import Star

__all__ = ["Star"]
