"""Postings as a stream."""
