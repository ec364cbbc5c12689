"""Trip files and the tables of this engine as frames."""
