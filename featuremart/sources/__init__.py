"""featuremart.sources."""
