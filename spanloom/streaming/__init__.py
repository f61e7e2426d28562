"""Streams of annotations."""
