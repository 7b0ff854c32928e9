"""Corpus operators: deduplication, decontamination, extraction, encoding, search.

Nothing outside this subpackage imports it.
"""
