"""The streaming job: one query that feeds three tables."""
