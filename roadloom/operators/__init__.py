"""Roadloom: operators."""
