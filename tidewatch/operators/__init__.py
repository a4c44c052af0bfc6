"""tidewatch operators."""
