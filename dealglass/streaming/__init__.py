"""Streaming forms of the triggers and of the refreshable monthly result."""
