"""Reading and writing: delimited text, named tables, sorted loads, SQL tables through a connector."""
