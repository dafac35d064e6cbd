"""Operators for preparing training corpora.

Nothing outside this subpackage imports it; it can be removed and the rest of
the library keeps working.
"""
