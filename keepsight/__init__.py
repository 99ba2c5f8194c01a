"""Customer churn and retention analytics as Spark DataFrame operators."""
