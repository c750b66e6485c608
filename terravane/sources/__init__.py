"""Readers and writers: landing folders, catalog zones, payloads, message streams."""
