"""Batch jobs; every path and the run date are parameters."""
