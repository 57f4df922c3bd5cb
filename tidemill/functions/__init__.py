"""functions of tidemill."""
