"""Operators of the consensus-ranking engine."""
