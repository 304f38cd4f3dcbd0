"""Training-data operators: scoring, near duplicates, search, mixing, sharding and tokenising.

Nothing else in the library imports this subpackage; it can be removed as a whole.
"""
