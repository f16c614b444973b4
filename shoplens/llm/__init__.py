"""Operators for training-data pipelines over text, web pages and embeddings."""
