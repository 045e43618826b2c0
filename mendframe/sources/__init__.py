"""Readers, writers and the sample-data generator."""
