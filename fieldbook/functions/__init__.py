"""Column functions: expressions in, expressions out; nothing here triggers a job."""
