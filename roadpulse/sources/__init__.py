"""Readers for files, directories and streams."""
