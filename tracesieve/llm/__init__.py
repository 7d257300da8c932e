"""Training-data operators: scoring, near-duplicates, decontamination, tokenising,
toxicity, secrets, page extraction, languages, vector search and quality.

Nothing else in the library imports this subpackage.
"""
