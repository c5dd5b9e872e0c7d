"""pulsegrid.operators."""
