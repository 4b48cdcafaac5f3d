"""Readers and writers for sequencing text formats and tables."""
