"""Operators for language-model training data: documents, conversations, pages and vectors."""
