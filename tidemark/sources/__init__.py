"""Scans: the service-request source, files, tables with versions."""
