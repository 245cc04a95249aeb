"""hirelake.operators."""
