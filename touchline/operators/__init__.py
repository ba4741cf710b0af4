"""DataFrame to DataFrame operators over the domain tables."""
