"""Readers and writers of behaviour logs."""
