"""Spark-first engine for cleaning, classifying and resolving registry-style data."""
