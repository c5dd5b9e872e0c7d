"""pulsegrid.plans."""
