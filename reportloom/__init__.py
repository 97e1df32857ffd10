"""reportloom: recurring business reports as Spark DataFrame jobs."""
