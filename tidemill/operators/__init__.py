"""operators of tidemill."""
