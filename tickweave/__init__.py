"""tickweave: event-time market-data analytics as PySpark DataFrames."""
