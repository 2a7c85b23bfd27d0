"""Complete runs and the query set."""
