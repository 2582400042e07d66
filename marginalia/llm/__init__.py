"""Training-data operators: scoring, mixing, near-duplicates, classifiers, sharding, media, search and packing.

Nothing outside this subpackage imports it.  Each module holds one operator with a general
interface, and the thin ``opN_*`` query that applies it to a whole table.
"""
