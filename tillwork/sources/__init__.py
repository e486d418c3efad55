"""Readers, snapshot sinks and the mapping of the test tables onto the sales model."""
