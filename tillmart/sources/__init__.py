"""Reading source relations and writing mart tables."""
