"""cadenza: a Spark-native music-catalogue analytics library.

Every public function takes and returns :class:`pyspark.sql.DataFrame`
objects (or :class:`pyspark.sql.Column` expressions); all heavy work runs as
Spark jobs planned by Catalyst.
"""

__version__ = "0.1.0"
