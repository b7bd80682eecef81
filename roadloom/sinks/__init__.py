"""Roadloom: sinks."""
