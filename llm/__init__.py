"""Training-data operators: mixing, tokenizing, privacy, fingerprints, language, archives, quality, search, URLs, near-duplicates,
spelling variants, sharding, periodic runs.

Nothing else in the library imports this subpackage.
"""
