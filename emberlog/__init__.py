"""Incident triage on log data, written as Spark DataFrame and column expressions."""
