"""Data sets behind the dashboard pages, each a function of report frames."""
