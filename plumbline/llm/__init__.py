"""Operators for preparing language-model training text.

Nothing outside this subpackage imports it; ``queries`` registers one query
per operator.
"""
