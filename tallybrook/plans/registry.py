"""Every named query of the engine and the SQL that gives the same rows."""

from __future__ import annotations

from tallybrook.plans import form_queries, function_queries, layout_queries, ledger_queries, operator_queries, page_queries, text_queries, view_queries

MODULES = (form_queries, function_queries, layout_queries, ledger_queries, operator_queries, page_queries, text_queries, view_queries)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: s for m in MODULES for name, s in m.SQL.items()}
