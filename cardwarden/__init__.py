"""Batch card-transaction analytics expressed as Spark DataFrame transforms."""
