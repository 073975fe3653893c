"""Station and vehicle telemetry analytics as lazy PySpark DataFrame operators."""
