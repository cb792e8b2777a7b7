"""Price-bar features, quality checks and forecasting as Spark DataFrame jobs."""
