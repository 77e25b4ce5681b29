"""Files that keep arriving: the same raw and typed forms over a file stream."""
