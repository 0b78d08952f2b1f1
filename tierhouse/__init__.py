"""Bronze -> silver -> gold warehouse building blocks for Spark.

Every function takes and returns DataFrames (or Columns); a Spark session is
always passed in or taken from the DataFrame, never held as module state.
"""

__version__ = "0.1.0"
