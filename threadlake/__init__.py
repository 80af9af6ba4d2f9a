"""Snapshot analytics on threaded content, as PySpark DataFrame operators."""
