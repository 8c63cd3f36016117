"""Column functions: text, term hashing, linear scores, labels and metrics."""
