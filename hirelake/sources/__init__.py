"""hirelake.sources."""
