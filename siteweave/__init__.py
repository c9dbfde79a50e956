"""Company-site and graph analytics as Spark DataFrame jobs."""
