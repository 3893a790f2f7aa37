"""Training-data operators on Spark: quality, dedup, PII, mixing, tokens, index, search.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``registry`` derives the registered
queries from them.
"""
