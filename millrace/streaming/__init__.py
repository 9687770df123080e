"""Streaming sinks and job control."""
