"""Session analytics on Spark: event logs in, per-session features, predictions and scores out."""
