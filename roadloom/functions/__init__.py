"""Roadloom: functions."""
