"""Consensus ranking analytics on PySpark."""
