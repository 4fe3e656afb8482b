"""Training-data operators: fixity, token files, dedup, tokenizers, language ID,
vector search, packing, quality rules and personal data.

Nothing else in the library imports this subpackage.
"""
