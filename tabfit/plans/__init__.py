"""Full feature frames and the query catalogue."""
