"""spanloom: span analytics for LLM applications, on PySpark DataFrames."""
