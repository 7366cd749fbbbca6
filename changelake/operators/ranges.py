"""Ordered operations over a whole table in two levels, so that no task orders all of it.

Rows are cut into spans of the order by its quantiles (the same literal bounds wherever the plan is evaluated). Within a span
a window does the work; what passes from span to span is one row a span and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = "__span"
#: Spans of one table, and rows from which on there are several.
PARTS, ROWS = 256, 500_000


def parts_of(rows: int) -> int:
    return max(1, min(PARTS, rows // ROWS))


def bounds(rows: DataFrame, order: str, parts: int | None = None) -> list[int]:
    """The order's quantiles: at most PARTS - 1 numbers, whatever the table."""
    if parts is None:
        parts = parts_of(rows.count())
    if parts < 2:
        return []
    cuts = rows.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
    return sorted(set(cuts or []))


def span_of(order: Column, cuts: list[int]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda b: b < order)) if cuts else F.lit(0)


def spanned(rows: DataFrame, order: str, parts: int | None = None) -> DataFrame:
    return rows.withColumn(SPAN, span_of(F.col(order), bounds(rows, order, parts)))


def running_sum(rows: DataFrame, by: list[str], order: str, value: Column, name: str, parts: int | None = None) -> DataFrame:
    """rows with the sum of value over the rows of their key up to and with them."""
    rows = spanned(rows.withColumn("__value", value), order, parts)
    sums = rows.groupBy(*by, SPAN).agg(F.sum("__value").alias("__sum"))
    before = F.sum("__sum").over(Window.partitionBy(*by).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1))
    keys = [F.col(k).alias(f"__by_{i}") for i, k in enumerate(by)]
    sums = sums.select(*keys, F.col(SPAN).alias("__at"), F.coalesce(before, F.lit(0)).alias("__base"))
    met = F.col(SPAN) == F.col("__at")
    for i, k in enumerate(by):
        met = met & F.col(k).eqNullSafe(F.col(f"__by_{i}"))
    own = F.sum("__value").over(Window.partitionBy(*by, SPAN).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("__own", own).join(sums, met)
    return rows.withColumn(name, F.col("__own") + F.col("__base")).drop("__value", "__own", "__base", "__at", SPAN, *(f"__by_{i}" for i in range(len(by))))


def previous(rows: DataFrame, order: str, columns: list[str], name: str, parts: int | None = None) -> DataFrame:
    """rows with a struct of these columns of the row before; null for the first."""
    rows = spanned(rows, order, parts)
    what = F.struct(*columns)
    last = rows.groupBy(SPAN).agg(F.max_by(what, order).alias("__last"))
    last = last.select(F.col(SPAN).alias("__at"), F.lag("__last").over(Window.partitionBy(F.lit(0)).orderBy(SPAN)).alias("__last"))  # one row a span
    own = F.lag(what).over(Window.partitionBy(SPAN).orderBy(order))
    rows = rows.withColumn("__own", own).join(last, F.col(SPAN) == F.col("__at"))
    return rows.withColumn(name, F.coalesce("__own", "__last")).drop("__own", "__last", "__at", SPAN)
