"""Roadloom: streaming."""
