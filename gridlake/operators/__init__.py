"""DataFrame-level operators on field tables."""
