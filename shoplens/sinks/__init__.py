"""Sinks: stored tables (with save modes and a row count), CSV, models."""
