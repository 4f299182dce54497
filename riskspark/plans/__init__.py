"""Whole runs: training, evaluation, and the registered queries with their SQL."""
