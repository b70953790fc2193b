"""featuremart.operators."""
