"""Incremental cleaning."""
