"""tillwright: payment analytics written as Spark DataFrame jobs."""
