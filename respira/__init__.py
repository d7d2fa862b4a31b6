"""respira: Spark-native quality control and flux analytics for chamber time series.

Every public operator takes DataFrames and column names and returns DataFrames; nothing is executed until
the caller runs an action, apart from small size probes on inputs that are not already known to be small.
"""

__version__ = "0.1.0"
