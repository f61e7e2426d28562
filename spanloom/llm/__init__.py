"""Operators on the records and texts of training corpora. Nothing else in the library imports this."""
