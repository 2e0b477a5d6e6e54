"""Training-data operators: one module per operator, their queries in ``queries.py``.

Nothing else in the library imports this package.
"""
