"""lakeloom: sinks."""
