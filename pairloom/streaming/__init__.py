"""Restartable runs over files that keep arriving."""
