"""The analyses as a whole, composed of the operators."""
