"""Change-data lakehouse on Spark: change events in, current-state tables and daily answers out."""
