"""Scans, file and JDBC sources, and sinks."""
