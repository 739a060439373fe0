"""Operators on query corpora: validation, reports, canonical results, curation."""
