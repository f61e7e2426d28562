"""Readers of the files that recordings, annotations and results are kept in."""
