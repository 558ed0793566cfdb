"""Operators over text, vectors and pages for training data; nothing else in the library imports this folder."""
