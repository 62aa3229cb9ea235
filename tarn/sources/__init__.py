"""Readers, contract checks and writers."""
