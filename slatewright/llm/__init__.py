"""Operators of a training-data pipeline: documents, pages and benchmark items in, decisions per row out."""
