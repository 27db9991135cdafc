"""Operators for preparing training data: encoding, extraction, filtering, deduplication and mixing.

Nothing else in the library imports this subpackage.
"""
