"""Punctuality analytics on scheduled trips, written as Spark jobs."""
