"""Whole runs put together from sources, operators and sinks."""
