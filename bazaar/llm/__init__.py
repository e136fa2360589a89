"""Training-data operators: search, archives, near-duplicates, packing,
toxicity, token counts, byte-level BPE, secret scans and URL filters.

Nothing outside this package imports it.
"""
