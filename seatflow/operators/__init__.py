"""DataFrame-to-DataFrame operators of the domain."""
