"""Whole runs from captured pages to event records."""
