"""pulsegrid.streaming."""
