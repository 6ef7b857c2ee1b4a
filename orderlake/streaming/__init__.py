"""Order files as they arrive."""
