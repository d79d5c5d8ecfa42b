"""The registered queries: flight-shaped views over the test tables, Spark and SQL sides."""
