"""Reading and writing: JSON lines, pages, snapshots, named models."""
