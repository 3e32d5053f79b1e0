"""Regional housing, income and election analytics as Spark DataFrame operators."""
