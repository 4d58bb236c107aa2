"""Readers and writers: raw CSV, lake tables, scratch tables and the events fixture."""
