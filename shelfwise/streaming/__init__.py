"""Structured Streaming forms of the call-log and history operators."""
