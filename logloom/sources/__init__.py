"""Readers for raw logs and the versioned tables the library writes."""
