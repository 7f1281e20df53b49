"""Relational and ML operators."""
