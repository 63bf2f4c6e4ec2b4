"""Training-data operators over document collections (see each module)."""
