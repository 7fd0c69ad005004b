"""Training-data operators: fingerprints, extraction, archives, repeats, joins, scoring, packing."""
