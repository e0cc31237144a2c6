"""DataFrame -> DataFrame operators grouped as the inventory."""
