"""Training-data operators: language id, LM scoring, mixing, secret scans, quality rules, fingerprints,
substring and near-duplicate removal, token files and byte-level BPE.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries only when it is present.
"""
