"""DataFrame operators; column names and thresholds are arguments."""
