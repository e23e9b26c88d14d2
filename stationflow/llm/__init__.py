"""Operators for preparing training text: search, packing, encoding, mixing, filtering, deduplication, redaction.

Nothing else in the package imports this subpackage. Every operator takes and returns DataFrames; ``queries`` holds the
registered queries. Texts may be null (an empty text) unless an operator says otherwise.
"""
