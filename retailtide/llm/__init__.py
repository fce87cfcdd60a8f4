"""Operators for training text: scans, near copies, packing, classifiers, search."""
