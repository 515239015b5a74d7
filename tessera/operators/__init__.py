"""DataFrame operators grouped by kind (see README for the inventory map)."""
