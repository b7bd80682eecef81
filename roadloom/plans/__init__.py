"""Roadloom: plans."""
