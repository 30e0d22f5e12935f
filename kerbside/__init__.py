"""Event-driven marketplace analytics on PySpark."""
