"""Plans: the end-to-end batch and the driver query catalogue."""
