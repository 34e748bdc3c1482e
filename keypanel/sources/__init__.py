"""Readers: delimited files, JSON, zipped CSV, HTML pages, stored tables."""
