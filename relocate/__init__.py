"""Spark jobs for moving tables between databases and proving that the move is right."""
