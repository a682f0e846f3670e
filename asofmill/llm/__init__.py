"""Training-data operators: search, deduplication, decontamination, mixing, scoring and language ID.

Each module holds one operator with a general interface; ``queries`` holds the thin
registered queries that apply them to whole tables.
"""
