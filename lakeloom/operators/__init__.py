"""lakeloom: operators."""
