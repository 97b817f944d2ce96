"""Column functions: dates, features, transforms and hashing."""
