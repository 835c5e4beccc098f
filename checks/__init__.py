"""Engine inputs derived from the driver tables, and the SQL that states the expected results."""
