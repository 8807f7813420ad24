"""lakehold: layered (raw -> cleaned -> marts) table pipelines as Spark DataFrame jobs.

Every operator is a function from DataFrames to DataFrames built from Spark's own
expressions, so Catalyst sees one declarative plan per query.
"""

__version__ = "0.1.0"
