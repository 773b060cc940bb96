"""Training-data operators: quality, language, secrets, fingerprints, deduplication,
decontamination, tokenisation and toxicity.

Nothing else in the library imports this package; ``__spark_entry__`` adds its queries
only when it is present.
"""
