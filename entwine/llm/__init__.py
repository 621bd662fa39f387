"""Operators for training data from text and names; nothing else in the library imports this package."""
