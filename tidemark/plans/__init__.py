"""Bronze, silver, gold and lifecycle recipes composed from the operators."""
