"""Anomaly detectors fitted and applied by Spark executors."""
