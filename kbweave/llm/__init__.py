"""Training-data operators.

Nothing outside this subpackage imports it; it can be deleted without touching the rest of the library.
"""
