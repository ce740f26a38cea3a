"""Settings and whole quality-control plans."""
