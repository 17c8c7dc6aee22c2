"""DataFrame-to-DataFrame operators over log tables."""
