"""Transformations from data frame to data frame."""
