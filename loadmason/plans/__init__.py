"""Whole jobs: loads, stores, inserts and the file-load script."""
