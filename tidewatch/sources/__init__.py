"""tidewatch sources."""
