"""tillmart: a daily retail sales mart expressed as Spark DataFrame jobs."""
