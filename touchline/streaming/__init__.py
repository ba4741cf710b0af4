"""Structured Streaming forms of the season operators.

Sources and sinks are given by the caller; each query has its own checkpoint folder.
"""
