"""Operators of a training-data pipeline (line dedup, secret scan, quality,
toxicity, decontamination, packing, token files, page extraction, WARC,
near-duplicates). Nothing else in the library imports this subpackage."""
