"""Point-in-time analytics and corpus preparation on PySpark."""
