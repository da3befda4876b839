"""Writers (W1-W7, L1-L3) and the JDBC keyed merge."""
