"""Column functions: each takes and returns a ``pyspark.sql.Column`` built from Spark built-ins."""
