"""Operators for preparing language-model training text, each on its own DataFrame."""
