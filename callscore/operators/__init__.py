"""DataFrame operators and the skew-safe building blocks (prefix, halo, grouped)."""
