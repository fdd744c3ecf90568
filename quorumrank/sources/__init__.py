"""Sources of the consensus-ranking engine."""
