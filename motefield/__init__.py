"""Point-splat analytics as Spark DataFrame operators."""
