"""Relational building blocks used by more than one model."""
