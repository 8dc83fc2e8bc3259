"""Readers, input schemas and report writers."""
