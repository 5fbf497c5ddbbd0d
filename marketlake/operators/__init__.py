"""DataFrame operators, by domain."""
