"""Wide-column tables on Spark DataFrames: cells, mutation logs, scans, filters, loads and streams."""
