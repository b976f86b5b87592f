"""DataFrame operators."""
