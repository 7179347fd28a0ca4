"""lakeloom: plans."""
