"""Scalar, aggregate and table functions."""
