"""hirelake.functions."""
