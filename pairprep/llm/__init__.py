"""Operators of a training-data pipeline over documents, chats and pages."""
