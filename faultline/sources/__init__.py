"""Scans, fixture feeds, generators and sinks."""
