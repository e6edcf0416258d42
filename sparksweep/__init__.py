"""sparksweep: sweeps, job analytics and training-data preparation as Spark jobs.

Every public function takes and returns DataFrames (or Columns). The library
never creates a SparkSession of its own; ``sparksweep.session`` is a helper for
tests, the bench and the command line only.
"""

__version__ = "0.1.0"
