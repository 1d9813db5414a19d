"""Report queries and layer jobs."""
