"""Readers and writers of documents, word boxes, ledgers and results."""
