"""Loads of raw tables as a stream of files."""
