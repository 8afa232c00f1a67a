"""All queries of the core, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators import chat
from millrace.plans import curation_plans, orphan_plans, page_plans

_MODULES = (orphan_plans, curation_plans, page_plans)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to chat payloads: content found, cleaned, written as Markdown and cut into parts."""
    pages = page_plans._html(spark, sf_dir)
    markdown = page_plans.kernel.parse_pages(pages, strict_info=False).where("_error is null").drop("_error")
    return chat.to_chat(markdown).select("pos", "id", "info", "data")
