"""streaming of tidemill."""
