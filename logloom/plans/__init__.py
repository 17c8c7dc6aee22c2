"""Whole jobs: derived inputs, training and scoring runs, and the query catalog."""
