"""Named analyses: each is a function from tables to a result DataFrame."""
