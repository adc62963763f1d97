"""Writers, each usable on a batch and from ``foreachBatch``."""
