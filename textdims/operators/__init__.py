"""textdims.operators."""
