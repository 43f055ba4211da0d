"""Machine-sensor telemetry analytics as plain Spark DataFrame operators."""
