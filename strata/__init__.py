"""strata — a medallion (Bronze → Silver → Gold) event-analytics library on Spark."""

__version__ = "0.1.0"
