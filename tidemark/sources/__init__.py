"""Reading and writing of snapshot, metric and tracker tables."""
