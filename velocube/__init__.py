"""velocube: trip-demand analytics expressed as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns) and builds a
lazy plan; nothing is collected to the driver unless a function documents a
bounded, scalar result.
"""

__version__ = "0.1.0"
