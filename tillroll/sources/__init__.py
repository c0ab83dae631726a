"""Readers and writers: test tables, CSV, layer tables, state, publishing."""
