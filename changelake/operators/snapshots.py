"""Snapshot loads: arrival ordinals and chunks, the proof of completion, verified emptiness, and what a table is owed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranges

OWED = ("in_progress", "awaiting_snapshot")


def ordinals(rows: DataFrame, table: str, order: str, parts: int | None = None) -> DataFrame:
    """The 1-based arrival ordinal of each row within its table."""
    return ranges.running_sum(rows, [table], order, F.lit(1), "ordinal", parts)


def chunks(numbered: DataFrame, most_rows: int, most_bytes: int | None = None, parts: int | None = None) -> DataFrame:
    """Chunks of consecutive rows of one table, at most most_rows of them, cut also where the bytes before a row pass a multiple of
    most_bytes. is_last: the chunk is its table's last, as an end marker or the next table's first row shows."""
    rows = numbered.withColumn("cut", F.expr(f"(ordinal - 1) div {most_rows}"))
    if most_bytes:
        rows = ranges.running_sum(rows, ["src_table"], "ordinal", F.col("nbytes"), "upto", parts)
        rows = rows.withColumn("cut", F.struct("cut", F.floor((F.col("upto") - F.col("nbytes")) / most_bytes).alias("by_bytes")))
    out = rows.groupBy("src_table", "cut").agg(F.count("*").alias("rows"), F.min("ordinal").alias("first"), F.max("ordinal").alias("last"))
    top = out.groupBy("src_table").agg(F.max("last").alias("__top"))
    number = F.row_number().over(Window.partitionBy("src_table").orderBy("first")) - 1  # chunks, not rows
    return out.join(top, "src_table").select("src_table", number.cast("long").alias("chunk"), "rows", "first", "last", (F.col("last") == F.col("__top")).alias("is_last"))


def completion(declared: DataFrame, committed: DataFrame) -> DataFrame:
    """Per table whether the rows committed are those declared; a table of either side only is not complete."""
    rows = declared.join(committed, "src_table", "full_outer")
    return rows.select("src_table", "declared", "committed", F.coalesce(F.col("declared") == F.col("committed"), F.lit(False)).alias("complete"))


def verified_empty(evidence: DataFrame) -> DataFrame:
    """evidence: src_table, scan_completed, records, source_rows, sampled_lsn. A table is proven empty only if its scan ended,
    gave no record, and the source counts none at the sampled position; it's fenced there."""
    verdict = (
        F.when(~F.col("scan_completed"), "owed").when(F.col("records") > 0, "loaded")
        .when(F.col("source_rows").isNull(), "unobservable").when(F.col("source_rows") == 0, "verified_empty").otherwise("owed")
    )
    return evidence.select("src_table", verdict.alias("verdict"), F.when(verdict == "verified_empty", F.col("sampled_lsn")).alias("fence_lsn"))


def owed(captured: DataFrame, states: DataFrame) -> DataFrame:
    """Captured tables whose image is owed: begun, or waiting to be."""
    return captured.join(states.where(F.col("snapshot_state").isin(*OWED)).select("src_table"), "src_table", "left_semi")


def unfinished(requested: DataFrame, states: DataFrame) -> DataFrame:
    """Requested tables whose image didn't reach its end, tables without a state included."""
    return requested.join(states.where("snapshot_state = 'complete'").select("src_table"), "src_table", "left_anti")


def source_missing(tables: DataFrame, drop_mode: str) -> DataFrame:
    """What becomes of tables that the source lacks. tables: src_table, done, missing, phase_ended, seen, wal_lsn. Absence is final
    only after a whole read at a known position that showed nothing of them; `ignore` isn't leave to destroy what is owed."""
    final = F.col("missing") & ~F.col("done") & F.col("phase_ended") & ~F.col("seen") & F.col("wal_lsn").isNotNull()
    fate = F.when(F.col("done") | ~F.col("missing"), "kept").when(final, "dropped" if drop_mode == "replicate" else "logged").otherwise("owed")
    return tables.select("src_table", fate.alias("fate"))


def consistent_point(readings: DataFrame) -> DataFrame:
    """readings (image, record_lsn, slot_lsn) with the position that both agree on; where they differ neither may be used."""
    differ = F.col("record_lsn") != F.col("slot_lsn")
    return readings.select("image", F.when(~F.coalesce(differ, F.lit(False)), F.coalesce("record_lsn", "slot_lsn")).alias("point"), F.coalesce(differ, F.lit(False)).alias("refused"))


def swapped(live: DataFrame, shadow: DataFrame, epoch: int) -> DataFrame:
    """What readers see after the swap: the shadow's rows alone, with the epoch that published them."""
    return shadow.select(*live.columns).withColumn("snapshot_epoch", F.lit(epoch).cast("long"))


def promote_interrupted(states: DataFrame) -> DataFrame:
    """At start: a snapshot that was in progress when the process died is owed anew."""
    state: Column = F.when(F.col("snapshot_state") == "in_progress", "awaiting_snapshot").otherwise(F.col("snapshot_state"))
    return states.withColumn("snapshot_state", state)
