"""Operators for preparing training data: packing, scoring, deduplication, mixing, language and toxicity."""
