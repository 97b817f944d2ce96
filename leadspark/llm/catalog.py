"""Importing this module fills the registry of the subpackage."""

from __future__ import annotations

from leadspark.llm import q_align, q_bursttrie, q_cotrain, q_decontam, q_htmltext, q_jaccard, q_linefreq, q_packing, q_pii, q_secrets, q_sharding, q_tokenfile, q_urlfilter  # noqa: F401
from leadspark.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
