"""Operators for text corpora and free text. Nothing outside of this package imports it."""
