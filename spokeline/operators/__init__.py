"""Cleaning, aggregation and checks over trip frames."""
