"""Reading, writing and describing stored data."""
