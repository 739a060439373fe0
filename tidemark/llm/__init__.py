"""Training-data operators: one module per operator, imported on demand.

Nothing outside this package imports it; ``queries`` holds the registered
queries and their SQL.
"""
