"""driftline: a PySpark engine for change-tracked workspace data."""
