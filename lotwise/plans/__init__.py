"""Parameterized plans over the operators."""
