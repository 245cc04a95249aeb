"""hirelake.plans."""
