"""Writing tables so that a rerun gives the same table."""
