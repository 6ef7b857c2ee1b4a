"""The three recipes: the same operators under different quality policies."""
