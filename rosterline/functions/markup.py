"""HTML fragments as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def escape(c: Column) -> Column:
    """XML-escape text."""
    c = c.cast("string")
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def cell(c: Column, tag: str = "td") -> Column:
    """One table cell; a null value gives no cell at all."""
    return F.coalesce(F.concat(F.lit(f"<{tag}>"), escape(c), F.lit(f"</{tag}>")), F.lit(""))


def row(cells: Sequence[Column], tag: str = "td") -> Column:
    return F.concat(F.lit("<tr>"), *[cell(c, tag) for c in cells], F.lit("</tr>"))


def header(titles: Sequence[str]) -> Column:
    return row([F.lit(t) for t in titles], "th")
