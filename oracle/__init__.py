"""The same questions as ANSI SQL over the raw tables, written apart from the Spark plans."""
