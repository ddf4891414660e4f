"""hoopflow: a Spark-first engine for basketball box scores, name resolution and squad decisions."""

__version__ = "0.1.0"
