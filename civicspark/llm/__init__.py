"""Operators on text for the preparation of training data."""
