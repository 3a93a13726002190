"""Micro-batch loading."""
