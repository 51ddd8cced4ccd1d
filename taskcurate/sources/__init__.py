"""Readers and writers for the table layouts the toolkit works on."""
