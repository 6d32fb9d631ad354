"""DataFrame operators: one table (or several) in, one table out."""
