"""Column functions: flags, durations, series and geometry."""
