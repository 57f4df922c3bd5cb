"""plans of tidemill."""
