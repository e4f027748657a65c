"""dripline: streaming telemetry and event jobs written as Spark DataFrame plans."""
