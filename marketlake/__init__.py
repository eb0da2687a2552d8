"""marketlake: Spark-native marketplace-seller analytics.

Operators take and return DataFrames (or Columns); nothing runs until an action.
"""

__version__ = "0.1.0"
