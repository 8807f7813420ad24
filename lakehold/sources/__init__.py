"""Readers, fixed schemas, landing-document parsing and table sinks."""
