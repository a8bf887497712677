"""Snapshot scans, marts, exports and record parsers."""
