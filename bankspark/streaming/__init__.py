"""Incremental drivers.  The reference has no stream operators; the only
streaming piece here runs the existing daily job for each newly landed day."""
