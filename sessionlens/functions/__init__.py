"""Column functions: flags, text, time, vectors, fuzzy names."""
