"""Readers, sinks and the incremental and repair loads."""
