"""Training-data pipeline operators.

One module per operator; ``queries`` registers them on the given tables.
Nothing outside this package imports it.
"""
