"""Operators for training-data corpora. Each module is one operator; `queries` registers them."""
