"""The registered queries: their inputs, the Spark jobs and the same results in SQL."""
