"""tributary: Spark-native operators for cumulative dimensions, fact modelling,
layout-aware joins, sessionization, analytical patterns, experiments and
pipeline checks.  Every operator takes DataFrames plus column names and
returns a DataFrame; nothing is collected to the driver."""

__version__ = "0.1.0"
