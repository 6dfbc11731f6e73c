"""tessera: DataFrame-in / DataFrame-out learning operators on Spark.

Every operator's heavy work is a Spark aggregate, join, window or
projection; the driver only ever holds small, size-bounded results
(moment rows, centroids, per-level split statistics).
"""

__version__ = "0.1.0"
