"""Reports over the three tables."""
