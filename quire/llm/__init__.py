"""Training-data operators.

Nothing else in the library imports this subpackage; it may be deleted whole.
Each module holds one operator with a general interface and, in ``registry``,
the thin query that applies it to its whole table.
"""
