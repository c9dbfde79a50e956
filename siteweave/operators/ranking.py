"""Numbering, first-per-key and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import keep

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def assign_uid(df: DataFrame, order_cols: Sequence[Column | str], uid: str = "UID") -> DataFrame:
    """Number all rows 1..n in the given order, which should be a total one.

    A window without partitions would sort everything in one task. Here the rows
    are sorted by range, each range is counted, and every row adds its place in
    the range to the rows in the ranges before it. Rows with equal leading columns
    spread over ranges by the columns after them. The sorted rows are checkpointed
    because a second sort may draw other range borders.
    """
    low = F.lit((1 << _ROW_BITS) - 1)
    placed = keep(df.orderBy(*order_cols).withColumn("_slot", F.monotonically_increasing_id())).withColumn(
        "_range", F.shiftright("_slot", _ROW_BITS)
    )
    # One row per sort partition; small whatever the data.
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_slot").bitwiseAND(low) + 1
    return (
        placed.join(F.broadcast(offsets), "_range").withColumn(uid, place).drop("_range", "_slot", "_before")
    )


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[Column | str],
    k: int,
    counter: str | None = None,
) -> DataFrame:
    """First k rows per key; each task cuts its own rows to k per key before the shuffle."""
    name = counter or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order_cols)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return ranked.withColumn(name, F.col(name).cast("long")) if counter else ranked.drop(name)


def dedupe_first(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[Column | str],
    counter: str | None = None,
) -> DataFrame:
    """First row per key, with its row number if a counter column is named."""
    return top_k(df, keys, order_cols, 1, counter)


def top_n(df: DataFrame, order_cols: Sequence[Column | str], n: int = fixed.TOP_GAMES) -> DataFrame:
    return df.orderBy(*order_cols).limit(n)


def sample_rows(
    df: DataFrame, order_cols: Sequence[Column | str], n: int = fixed.SAMPLE_ROWS
) -> DataFrame:
    """The few rows a result is described by."""
    return top_n(df, order_cols, n)


def colour_index(df: DataFrame, label: str, alias: str = "colour") -> DataFrame:
    """Palette colour per distinct label, in label order; the palette repeats.

    Labels are schema names, so the window over all of them is small.
    """
    palette = F.array(*[F.lit(c) for c in fixed.PALETTE])
    place = (F.row_number().over(Window.orderBy(label)) - 1) % len(fixed.PALETTE)
    return df.select(label).distinct().withColumn(alias, F.get(palette, place))
