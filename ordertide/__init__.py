"""Order analytics on Spark: staging, star schema, marts, CDC, history, checks."""
