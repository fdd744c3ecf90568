"""Functions of the consensus-ranking engine."""
