"""Structured Streaming forms of the landing, validation and change-application operators."""
