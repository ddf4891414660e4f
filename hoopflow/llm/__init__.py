"""Operators for text and model-training data; nothing outside this subpackage imports it."""
