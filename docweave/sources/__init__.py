"""Where node and edge tables come from, and where documents go."""
