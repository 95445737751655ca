"""Column expressions: byte codecs, row keys, delimited text."""
