"""Readers and writers: CSV drops, captured pages, tables, reports."""
