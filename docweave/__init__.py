"""Graph-to-document analytics on Spark."""
