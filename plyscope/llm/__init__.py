"""Operators for preparing language-model training data, over tables of documents."""
