"""Change data of a relational table into a partitioned lake table, on Spark."""
