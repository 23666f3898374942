"""Readers and writers for the record formats of civic data."""
