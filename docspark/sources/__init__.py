"""Readers: each returns the document table (or triples), rejected records included with their reason."""
