"""Operators of a training-data pipeline: quality, rules, token rollups,
toxicity, repeated text, tokenization, page text, near duplicates, vector
search, source mixing, whitening, archives and hard negatives.  Nothing
outside this subpackage imports it."""
