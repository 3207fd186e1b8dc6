"""DataFrame-to-DataFrame operators: cleaning, declared joins, metric views, value resolution."""
