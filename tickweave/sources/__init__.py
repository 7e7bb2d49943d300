"""Reading logs and configuration, writing stored tables."""
