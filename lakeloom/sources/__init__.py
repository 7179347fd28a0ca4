"""lakeloom: sources."""
