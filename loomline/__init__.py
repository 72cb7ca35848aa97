"""Loomline: text-data preparation, curation and retrieval on Spark."""
