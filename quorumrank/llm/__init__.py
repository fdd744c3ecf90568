"""Training-data operators: one module per operator, thin driver queries in ``queries``."""
