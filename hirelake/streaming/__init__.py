"""hirelake.streaming."""
