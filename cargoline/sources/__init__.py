"""Sources: CSV scans (S1-S4) and the deliveries table derived from the test tables."""
