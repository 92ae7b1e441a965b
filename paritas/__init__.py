"""Table reconciliation on Spark: do two tables hold the same data?"""

__version__ = "0.1.0"
