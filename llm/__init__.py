"""Operators for preparing language-model training data. Nothing else in this repository imports this package."""
