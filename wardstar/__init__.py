"""wardstar: clinical star-schema loads and questions as Spark DataFrame jobs."""
