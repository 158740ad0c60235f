"""Operators that prepare a text corpus for language-model training. Nothing else in the library imports this package."""
