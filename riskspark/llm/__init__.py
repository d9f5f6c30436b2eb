"""Operators of a training-data pipeline: URL filters, mixing, tokenising,
language and toxicity scores, license scans, and four kinds of deduplication.
Nothing else in the library imports this subpackage."""
