"""Operators of a training-data pipeline: URL filters, tokenizers, vector search,
near-duplicates, mixing, chat formatting, quality, language-model scores, archives.

Nothing else in the library imports this subpackage.
"""
