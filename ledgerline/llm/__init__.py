"""Operators for preparing text corpora, and the registered queries over them."""
