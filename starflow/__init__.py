"""A clickstream star schema on Spark: raw event CSV to dimensions, facts and catalog tables."""
