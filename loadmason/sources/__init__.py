"""Delimited text, staged files, JDBC and the write-only data source."""
