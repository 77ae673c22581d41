"""Readers, writers and the views that present the test tables as behaviour data."""
