"""Audit-log and event-log analytics as plain Spark DataFrame jobs."""
