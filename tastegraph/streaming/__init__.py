"""tastegraph.streaming."""
