"""The three jobs, composed of the operators."""
