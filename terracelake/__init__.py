"""Batch analytics over a bronze / silver / gold data lake, written for Spark."""
