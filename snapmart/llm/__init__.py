"""Training-data operators: counting, packing, scanning, filtering, deduplication, formatting.

Each module holds one operator with its own interface; ``queries`` applies them
to the given tables. Nothing outside this subpackage imports it.
"""
