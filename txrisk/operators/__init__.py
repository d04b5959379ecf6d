"""DataFrame-to-DataFrame steps of the risk pipeline."""
