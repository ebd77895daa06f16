"""Sinks: files and catalog tables."""
