"""DataFrame operators by business domain."""
