"""gridops: hourly activity analytics for a city grid, written for Spark.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns). Nothing here creates a session, holds global state or moves table
contents through the driver.
"""
