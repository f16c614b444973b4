"""Incremental loading of newly arrived source files."""
