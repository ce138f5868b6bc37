"""Training-data operators: scoring, de-duplication, filtering, mixing, formatting.

Nothing else in the library imports this subpackage.  Each module states how it
treats nulls, empty texts, ties, repeated rows, empty tables and extra columns.
"""
