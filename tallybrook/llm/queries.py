"""The queries of all operators in this subpackage."""

from __future__ import annotations

from . import bitslice, chosen_path, langid, merkle, mixing, packing, pii, pq_dedup, quality, repair, resampling, toxicity, url_rules

MODULES = (repair, pii, bitslice, quality, chosen_path, url_rules, mixing, packing, pq_dedup, langid, resampling, toxicity, merkle)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: s for m in MODULES for name, s in m.SQL.items()}
