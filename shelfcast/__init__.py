"""Stock allocation analytics as Spark DataFrame operators."""
