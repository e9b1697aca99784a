"""Whole jobs: sources through operators to sinks."""
