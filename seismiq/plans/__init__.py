"""Query plans registered with the driver (``__spark_entry__``)."""
