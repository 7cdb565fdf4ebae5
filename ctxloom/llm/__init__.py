"""Training-data operators: tokenising, scanning, scoring, mixing and deduplicating text corpora.

Each module holds one operator with a general interface plus the thin query that
applies it to the ``documents`` table.  Nothing outside this package imports it.
"""
