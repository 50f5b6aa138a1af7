"""Gazette: article curation as Spark jobs."""
