"""Readers: landing zone, workbooks, published JSON, series configuration."""
