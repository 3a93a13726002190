"""Column-level building blocks: types, cell conversions, digests."""
