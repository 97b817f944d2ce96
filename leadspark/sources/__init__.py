"""Readers: company master, register events, cached panels."""
