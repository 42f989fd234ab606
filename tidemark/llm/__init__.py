"""Training-data operators: similarity joins, extraction, quality, packing.

Nothing else in the library imports this subpackage. Its registered queries are
in ``tidemark.llm.queries``.
"""
