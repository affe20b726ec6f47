"""Newspaper-article indexing and discovery as Spark DataFrame jobs."""
