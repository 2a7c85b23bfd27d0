"""Scans, archives and table storage."""
