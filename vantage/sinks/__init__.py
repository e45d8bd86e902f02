"""Sinks: materialised summary tables, views, the append-only termination log."""
