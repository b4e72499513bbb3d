"""starmart: cleaning, star-schema warehousing and BI reporting as Spark jobs."""
