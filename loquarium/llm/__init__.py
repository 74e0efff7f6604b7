"""Training-data operators: decontamination, WARC bundles, language ID, token files, deduplication, packing, near-duplicate vectors.

Nothing else in the library imports this subpackage; ``queries.py`` holds its thin ``opN_`` queries and their SQL.
"""
