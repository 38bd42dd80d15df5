"""Quayside: everyday analytics engineering on PySpark DataFrames."""
