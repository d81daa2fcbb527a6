"""Readers and the synthetic generator."""
