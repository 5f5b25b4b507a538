"""Sinks: XES logs, event-log tables, reports."""
