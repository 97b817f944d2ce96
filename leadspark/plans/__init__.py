"""Registered queries, each beside its SQL twin, and the end-to-end jobs."""
