"""citybeat: urban transport analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus column names / parameters) and
returns a DataFrame.  Nothing is collected to the driver; the work is expressed
with built-in Spark SQL functions, joins, aggregations and windows so that
Catalyst can prune columns, push filters into the Parquet scan and plan
partial (map-side) aggregation.
"""

__version__ = "0.1.0"
