"""Domain models, each one DataFrame function built from the operators."""
