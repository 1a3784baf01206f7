"""Column helpers and calendar generators."""
