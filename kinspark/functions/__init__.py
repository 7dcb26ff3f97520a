"""Column functions: normalisation, tokens, keys and similarities."""
