"""Relational building blocks that stay balanced when one key is very large."""
