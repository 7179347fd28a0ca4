"""lakeloom: lakehouse analytics jobs written as DataFrame-to-DataFrame functions."""
