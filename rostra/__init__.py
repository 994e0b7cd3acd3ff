"""Rostra: stance-over-time analytics for large text corpora on Spark.

Every public function takes and returns DataFrames (or Columns); nothing here
holds a session, a catalog name or collected data.
"""

__version__ = "0.1.0"
