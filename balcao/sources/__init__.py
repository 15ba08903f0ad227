"""Readers and writers: the raw feed, the warehouse tables, the test tables."""
