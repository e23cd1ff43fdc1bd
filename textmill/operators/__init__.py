"""Distributed operators on pages, documents and run tables."""
