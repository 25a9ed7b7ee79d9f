"""DataFrame operators, free of marketplace names: columns and thresholds are arguments."""
