"""Readers, normalisers and writers."""
