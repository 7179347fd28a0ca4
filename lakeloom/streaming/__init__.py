"""lakeloom: streaming."""
