"""panelforge: panel and time-series feature engineering on Spark DataFrames.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or builds a
``Column``), so a whole feature specification becomes one lazy Catalyst plan.
"""

__version__ = "0.1.0"
