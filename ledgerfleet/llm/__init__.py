"""Operators of a training-data pipeline: WARC archives, deduplication,
decontamination, filters, personal data, packing and vector search."""
