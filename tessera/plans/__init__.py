"""Derived inputs and the query catalogue (Spark side and SQL oracle)."""
