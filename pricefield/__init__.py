"""Price panels, features, forecasts and their evaluation as Spark DataFrame jobs."""
