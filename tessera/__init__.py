"""Map-data analytics on Spark: sources, operators, layers and tiles as DataFrame functions."""
