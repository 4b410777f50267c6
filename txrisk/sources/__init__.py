"""Where messages and stored rows are read from."""
