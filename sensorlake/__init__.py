"""Cleaning, quality reports and daily roll-ups of sensor telemetry as Spark DataFrame jobs."""
