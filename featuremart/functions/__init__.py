"""featuremart.functions."""
