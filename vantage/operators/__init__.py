"""Relational building blocks composed from Spark's own operators."""
