"""Operators for building training data from documents, conversations and web pages."""
