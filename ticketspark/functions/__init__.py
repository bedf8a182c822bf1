"""Column builders: calendar, encodings, hashing, parsing and error metrics."""
