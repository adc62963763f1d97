"""Readers: stored tables, topics, metric batches on the wire, event tables."""
