"""eventide: event, policy-order and data-quality analytics as Spark jobs.

Every operator is a function from DataFrames (plus an explicit ``as_of``
timestamp where the original logic reads the wall clock) to a DataFrame.
Nothing is collected to the driver; plans are left to Catalyst and AQE.
"""

AS_OF = "2024-01-31 00:00:00"
