"""textdims.streaming."""
