"""Race telemetry analytics expressed as Spark DataFrame plans."""
