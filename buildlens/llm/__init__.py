"""Training-data operators: filtering, deduplication, search, tokenising and packing.

Nothing outside this subpackage imports it. Each module holds one operator; ``queries``
registers the queries that apply them to the tables.
"""
