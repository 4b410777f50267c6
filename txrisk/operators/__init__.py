"""DataFrame to DataFrame steps shared by the batch and streaming plans."""
