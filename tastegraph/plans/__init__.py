"""tastegraph.plans."""
