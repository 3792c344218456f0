"""Operators for preparing language-model training text at scale.

Nothing else in the package imports this subpackage; it can be removed as a whole.
"""
