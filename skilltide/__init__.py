"""Job-skill analytics as Spark operators over DataFrames."""
