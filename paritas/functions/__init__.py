"""Column builders: each takes Columns and returns a Column, nothing is executed."""
