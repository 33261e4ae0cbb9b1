"""Operators on tables: chapters, duplicates, checks, export, samples."""
