"""Multi-table jobs."""
