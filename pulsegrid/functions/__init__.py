"""pulsegrid.functions."""
