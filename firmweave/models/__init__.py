"""Split, fit, score, evaluate and keep models."""
