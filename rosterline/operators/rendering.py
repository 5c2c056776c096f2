"""Tables rendered into one text per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from .keys import with_row_key


def render_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], cells: Sequence[Column], name: str) -> DataFrame:
    """Ordered ``<tr>`` rows of each key, concatenated.

    Rows are range-partitioned by (key, order, row text), so a hot key spreads
    over many tasks; each task renders its stretch, and the stretches, at most
    one per partition and key, are put together in partition order.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    sorts = [f"_o{i}" for i in range(len(order))]
    rows = df.select(*by, *[c.alias(s) for s, c in zip(sorts, order)], markup.row(cells).alias("_tr"))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = (
        rows.repartitionByRange(width, *by, *sorts, "_tr")
        .withColumn("_part", F.spark_partition_id())
        .groupBy(*by, "_part")
        .agg(F.array_sort(F.collect_list(F.struct(*sorts, "_tr"))).alias("_rows"))
        .select(*by, "_part", F.concat_ws("", F.transform("_rows", lambda r: r["_tr"])).alias("_html"))
    )
    return stretches.groupBy(*by).agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("_part", "_html"))), lambda r: r["_html"])).alias(name)
    )


def render_chunks(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], cells: Sequence[Column], titles: Sequence[str], css_class: str,
    rows_per_chunk: int = 1_000,
) -> DataFrame:
    """``by``, chunk, html: tables as texts of bounded size, for keys with any number of rows.

    Chunk 0 is the table's head and the last one its foot; those between hold ``rows_per_chunk`` rows each, in ``order`` (which should be
    total; otherwise a digest of the row settles it). The texts of a key in chunk order are its table; putting them together
    is left to what writes it out. No task holds a key, and only order columns are dealt to ranges.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    sorts = [f"_o{i}" for i in range(len(order))]
    rows = df.select(*by, *[c.alias(s) for s, c in zip(sorts, order)], markup.row(cells).alias("_tr"))
    keyed = with_row_key(rows, [*by, *sorts], "_n").select(*by, "_n", "_tr")
    # Places of all keys run on, so a key's first place tells the place inside the key.
    spans = keyed.groupBy(*by).agg(F.min("_n").alias("_first"), F.count("*").alias("_rows"))
    named = spans.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_first")
    test = F.lit(True)
    for i, c in enumerate(by):
        test = test & keyed[c].eqNullSafe(named[f"_k{i}"])
    placed = keyed.join(named, test).withColumn("chunk", F.floor((F.col("_n") - F.col("_first")) / rows_per_chunk) + 1)
    ordered = F.array_sort(F.collect_list(F.struct("_n", "_tr")))
    body = placed.groupBy(*by, "chunk").agg(F.concat_ws("", F.transform(ordered, lambda r: r["_tr"])).alias("html"))
    head = F.concat(F.lit(f'<table class="{css_class}"><thead>'), markup.header(titles), F.lit("</thead><tbody>"))
    last = F.ceil(F.col("_rows") / rows_per_chunk) + 1
    ends = F.array(F.struct(F.lit(0).cast("bigint").alias("chunk"), head.alias("html")), F.struct(last.alias("chunk"), F.lit("</tbody></table>").alias("html")))
    return body.unionByName(spans.select(*by, F.inline(ends)))


def table_around(rows: Column, titles: Sequence[str], css_class: str, empty: str | None = None) -> Column:
    """A whole table around rendered rows; ``empty`` is inserted as is when there are none."""
    body = rows if empty is None else F.coalesce(rows, F.lit(empty))
    return F.concat(
        F.lit(f'<table class="{css_class}"><thead>'), markup.header(titles), F.lit("</thead><tbody>"), body,
        F.lit("</tbody></table>"),
    )


def html_tables(
    entities: DataFrame,
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    cells: Sequence[Column],
    titles: Sequence[str],
    css_class: str,
    name: str,
    empty: str | None = None,
) -> DataFrame:
    """One table per entity, with the ``empty`` body for entities without rows."""
    rendered = render_rows(df, by, order, cells, "_body")
    joined = entities.join(rendered, list(by), "left")
    return joined.select(*entities.columns, table_around(F.col("_body"), titles, css_class, empty).alias(name))
