"""Checks on the sample tables: Spark queries and the SQL they are held against."""
