"""Training-data operators: scoring, packing, fingerprints, near-duplicates, toxicity,
page extraction, mixing, chat formatting and secret scans.

Nothing else in the library imports this package; it imports only general helpers."""
