"""Runs over several tables."""
