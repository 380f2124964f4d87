"""DataFrame-in, DataFrame-out operators. Column names are parameters with the logical defaults."""
