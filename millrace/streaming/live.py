"""The row-wise stages on streams, and first-row deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.html import kernel
from millrace.operators import chat


def parse_stream(pages: DataFrame, **options) -> DataFrame:
    """Pages to Markdown or simple HTML as they arrive; same rows as the batch stage."""
    return kernel.parse_pages(pages, **options)


def chat_stream(markdown: DataFrame, role: str = "user") -> DataFrame:
    return chat.to_chat(markdown, role)


def first_of_each(rows: DataFrame, key: str = "id", at: str = "ingested_at", delay: str | None = None) -> DataFrame:
    """The first row to arrive of each key, however late; every key stays in the state, and no other column does.

    ``delay`` bounds the state for inputs in order: a key is forgotten ``delay`` after its time ``at``,
    and rows that arrive further than that behind the newest time are lost, first rows included.
    """
    if delay is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
