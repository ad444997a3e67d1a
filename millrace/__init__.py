"""Millrace: analytic operators, change feeds and declarative queries on PySpark."""
