"""Column -> Column functions; built-ins only, no Python in the row path."""
