"""Campaign-finance plans built from the generic operators."""
