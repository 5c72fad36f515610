"""Learning and preparation operators built from DataFrame operations."""
