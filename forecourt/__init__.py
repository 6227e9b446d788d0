"""Station price analytics as Spark DataFrame operators."""
