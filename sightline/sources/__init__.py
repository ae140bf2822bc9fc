"""Reading landed files and relational tables, and writing tables."""
