"""Player analytics for game telemetry, written as Spark DataFrame functions."""
