"""DataFrame to DataFrame operators over the document table."""
