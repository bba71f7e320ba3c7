"""Spark-first analytics operators, plans and streams."""
