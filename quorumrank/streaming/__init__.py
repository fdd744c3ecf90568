"""Streaming of the consensus-ranking engine."""
