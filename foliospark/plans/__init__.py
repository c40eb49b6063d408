"""Registered queries and the document workflow."""
