"""rillmark: clickstream analytics and corpus preparation on PySpark."""
