"""textdims.functions."""
