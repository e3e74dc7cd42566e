"""Operators for building training data from documents, pages and embeddings."""
