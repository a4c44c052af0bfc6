"""tidewatch streaming."""
