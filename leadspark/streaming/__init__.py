"""Register counts kept up to date from a stream of publications."""
