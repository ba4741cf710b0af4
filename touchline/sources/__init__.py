"""Scans, record decoding, sinks and the bridge from the test tables."""
