"""tidelog: change-log snapshots, catch-up and append-only targets on Spark."""
