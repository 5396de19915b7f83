"""Retail analytics as Spark jobs: cleaning, star schema, metrics and sales queries."""
