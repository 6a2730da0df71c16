"""DataFrame operators over layers."""
