"""Building documents again when the graph changes."""
