"""Operators on document corpora: scoring, matching, searching, cleaning and mixing.

Nothing else in the library imports this subpackage.
"""
