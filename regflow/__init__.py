"""Monthly vehicle-registration analytics as Spark DataFrame jobs."""
