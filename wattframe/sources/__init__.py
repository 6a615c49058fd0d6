"""Readers and parsers: files and text columns in, typed rows out."""
