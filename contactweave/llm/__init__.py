"""Training-data operators: sharding, dedup, quality, language, tokens, packing, search, mixing.

Nothing outside this subpackage imports it.
"""
