"""Panel pressure analytics as Spark DataFrame jobs."""
