"""trackside: season-based motorsport timing analytics on PySpark DataFrames."""
