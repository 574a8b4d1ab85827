"""obsmart: long-horizon database observability on PySpark DataFrames."""
