"""textdims.sources."""
