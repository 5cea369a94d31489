"""Readers: files, message topics and tables."""
