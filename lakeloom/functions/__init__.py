"""lakeloom: functions."""
