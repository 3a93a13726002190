"""Frame-level operators: schema checks, checked conversion, diffs, faults, keys."""
