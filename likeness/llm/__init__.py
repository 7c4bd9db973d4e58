"""Training-data operators: tokenisation, search, quality, chat formatting,
packing, secrets, near-duplicates, personal data and language.

Nothing else in the library imports this subpackage.
"""
