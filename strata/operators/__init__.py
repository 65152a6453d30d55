"""DataFrame → DataFrame transforms of each layer (no actions inside)."""
