"""Relational operators of the vehicle-market engine."""
