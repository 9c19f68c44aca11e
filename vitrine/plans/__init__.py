"""The bronze and silver jobs, composed from the operators."""
