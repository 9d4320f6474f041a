"""tastegraph.operators."""
