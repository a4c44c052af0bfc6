"""tidewatch functions."""
