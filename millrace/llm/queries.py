"""All queries of the subpackage, with their SQL."""

from __future__ import annotations

from millrace.llm import boilerplate_plans, budget_plans, label_records, lookalike_plans, markup_plans, spam_plans

_MODULES = (label_records, boilerplate_plans, markup_plans, lookalike_plans, budget_plans, spam_plans)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
