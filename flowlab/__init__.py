"""flowlab: Spark-native operators from raw tables to scored, ranked and evaluated results.

Every operator takes DataFrames and returns DataFrames; none runs an action.
"""

__version__ = "0.1.0"
