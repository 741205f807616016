"""Relational and document operators, written as DataFrame transformations."""
