"""Governed analytics for a retail star schema, expressed as Spark DataFrames."""
