"""Operators of a training-data pipeline: chat formatting, classifiers, filters, search, packing, token files."""
