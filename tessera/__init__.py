"""tessera: a Spark-native engine for tabular feature preparation and
numeric-target prediction.

Every operator is a DataFrame-in / DataFrame-out function.  Fitted state
(means, quantiles, category codes, scaler parameters) is kept either as a
handful of driver scalars whose count depends on the number of columns, or
as small parameter DataFrames joined back to the data.
"""

__version__ = "0.1.0"
