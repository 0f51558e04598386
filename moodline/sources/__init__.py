"""Reading and writing the interchange files and stage tables."""
