"""Operators for training text: grouped splits, packing, leaked evaluation text, look-alike text."""
