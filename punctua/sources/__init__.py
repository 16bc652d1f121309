"""Scans, writes and file checks."""
