"""tastegraph.sources."""
