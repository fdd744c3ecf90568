"""Plans of the consensus-ranking engine: importing the modules registers their queries."""
