"""sources of tidemill."""
