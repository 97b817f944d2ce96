"""Importing this module fills the registry."""

from __future__ import annotations

import importlib

from leadspark.registry import ORACLES, QUERIES

MODULES = ("q_panel", "q_features", "q_register", "q_profile", "q_ranking", "q_metrics", "q_sampling", "q_encoders", "q_lookalike", "q_models", "q_jobs")

for _name in MODULES:
    importlib.import_module(f"leadspark.plans.{_name}")

__all__ = ["ORACLES", "QUERIES"]
