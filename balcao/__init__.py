"""balcao: retail sales analytics as lazy Spark DataFrame jobs."""
