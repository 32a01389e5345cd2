"""Readers: files to typed DataFrames."""
