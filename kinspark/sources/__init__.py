"""Scans, sinks and the views that present the driver's tables as record sources."""
