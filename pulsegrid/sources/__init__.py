"""pulsegrid.sources."""
