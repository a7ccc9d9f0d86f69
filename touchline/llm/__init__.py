"""Operators for preparing training text: extraction, deduplication, filtering, mixing and encoding of documents.

Nothing outside this subpackage imports it. ``queries`` registers one query per operator.
"""
