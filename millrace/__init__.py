"""millrace: daily data-hub jobs written as Spark DataFrame programs."""
