"""Streams of keyed JSON status messages, turned into queryable tables with Spark."""
