"""Spark-native analytics for tabular risk data.

Every operator is a function from DataFrames to DataFrames. Functions named
``fit_*`` run a job and return a small fitted object (means, categories,
centres); everything else stays lazy.
"""

__version__ = "0.1.0"
