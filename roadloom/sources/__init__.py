"""Roadloom: sources."""
