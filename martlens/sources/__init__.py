"""Reading the raw tables, landing them as bronze, and writing catalog tables."""
