"""Corpus curation on Spark: features, gates, domains, scores, selection, repair, packaging and validation."""
