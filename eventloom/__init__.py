"""Spark jobs that turn captured web pages into a checked table of business events."""
