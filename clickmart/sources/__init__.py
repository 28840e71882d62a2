"""Readers and writers for the file formats and tables the jobs use."""
