"""logloom: log analytics and anomaly detection as Spark DataFrame operators."""

__version__ = "0.1.0"
