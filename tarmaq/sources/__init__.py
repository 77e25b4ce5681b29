"""Reading and writing: delimited text, tables, snapshots, shared intermediate tables."""
