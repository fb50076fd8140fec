"""Session set-up and named queries."""
