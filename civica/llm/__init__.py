"""Operators for training-data pipelines over documents, pages, vectors and chats."""
