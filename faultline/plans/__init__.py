"""Registered queries, their SQL twins and the metric catalogue."""
