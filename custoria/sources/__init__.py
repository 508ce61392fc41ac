"""Scans of the four customer datasets, parameterised SQL, and sinks."""
