"""rowmill: labelled tabular classification as Spark DataFrame operators.

Every operator takes and returns DataFrames. Rows are identified by an explicit
unique key column, never by position, and only values bounded by the number of
columns or label values reach the driver.
"""

__version__ = "0.1.0"
