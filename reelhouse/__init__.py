"""reelhouse: a Spark-native ratings and catalogue lakehouse.

Plain functions ``DataFrame -> DataFrame`` built on Spark SQL and Spark ML:
bronze/silver/gold layer I/O, cleaning and deduplication, dimensions and
aggregates, per-group rankings, vote-weighted scores, profiling, metadata
enrichment from landed JSON payloads and ALS recommendations.
"""

__version__ = "0.1.0"
