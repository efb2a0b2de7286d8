"""Spark-first analytics engine for governing document corpora."""
