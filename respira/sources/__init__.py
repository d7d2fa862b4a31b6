"""Scans of logger text files, monthly tables and dimension sheets, and the sinks that write results."""
