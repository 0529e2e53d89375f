"""Operators for preparing language-model training data; nothing else in the library imports this."""
