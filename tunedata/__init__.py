"""tunedata: Spark-native data work for instruction tuning.

Every operator takes and returns a ``pyspark.sql.DataFrame`` (or a ``Column``
for scalar helpers); the heavy work runs on executors as Catalyst plans.
"""

__version__ = "0.1.0"
