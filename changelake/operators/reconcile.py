"""Decision tables over observations: may this run stream from the slot, and does its offset file agree with what is durable?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdicts on a slot, cause before symptom.
SLOT_VERDICTS = (
    "source_unobservable", "fresh_start", "no_durable_destination_row", "source_identity_changed", "source_timeline_changed",
    "source_lsn_regressed", "slot_missing", "slot_recreated", "slot_ahead_of_destination", "no_durable_row_full_snapshot", "ok",
)


def slot_verdicts(seen: DataFrame) -> DataFrame:
    """seen, with verdict and action (proceed, resnapshot or refuse). Columns of seen: observable, durable_lsn, slot_exists,
    restart_lsn, confirmed_flush_lsn, current_wal_lsn, system_identifier, timeline_id, the same four with prev_ for the
    observation before, and destination_rows (null: not looked at, which counts as populated)."""
    c = F.col
    changed = lambda name: c(f"prev_{name}").isNotNull() & c(name).isNotNull() & (c(f"prev_{name}") != c(name))
    back = c("restart_lsn") < c("prev_restart_lsn")
    # A restart position alone may fall behind after a crash; a slot made anew falls behind in both.
    both_back = back & (c("prev_confirmed_flush_lsn").isNull() | c("confirmed_flush_lsn").isNull() | (c("confirmed_flush_lsn") < c("prev_confirmed_flush_lsn")))
    verdict = (
        F.when(~c("observable"), "source_unobservable")
        .when(c("durable_lsn").isNull() & (~c("slot_exists") | c("confirmed_flush_lsn").isNull()), "fresh_start")
        .when(c("durable_lsn").isNull(), "no_durable_destination_row")
        .when(changed("system_identifier"), "source_identity_changed").when(changed("timeline_id"), "source_timeline_changed")
        .when(c("current_wal_lsn") < c("durable_lsn"), "source_lsn_regressed").when(~c("slot_exists"), "slot_missing")
        .when(both_back, "slot_recreated").when(c("confirmed_flush_lsn") > c("durable_lsn"), "slot_ahead_of_destination").otherwise("ok")
    )
    populated = c("destination_rows").isNull() | (c("destination_rows") > 0)
    action = (
        F.when(verdict.isin("source_unobservable", "fresh_start", "ok"), "proceed")
        .when((verdict == "no_durable_destination_row") & populated, "refuse").otherwise("resnapshot")
    )
    return seen.withColumn("verdict", verdict).withColumn("action", action)


def offset_decisions(seen: DataFrame) -> DataFrame:
    """seen, with decision. Columns: file_present, file_decodes, file_lsn, file_offset (a map or text), row_present, row_lsn,
    row_offset (null: none kept), accept_orphan, repair."""
    c = F.col
    rebuilt = c("repair") & c("row_offset").isNotNull()
    missing = F.when(rebuilt, "file_missing_rebuilt").when(c("row_offset").isNull(), "file_missing_no_durable_offset").otherwise("file_missing_repair_disabled")
    decision = (
        F.when(~c("row_present") & ~c("file_present"), "fresh_start").when(~c("row_present") & c("accept_orphan"), "orphan_accepted_resnapshot")
        .when(~c("row_present"), "refused_orphan_file").when(~c("file_present"), missing).when(~c("file_decodes"), "file_corrupt_rebuilt")
        .when(c("file_lsn") > c("row_lsn"), "file_ahead_rebuilt").when(c("file_lsn") < c("row_lsn"), "file_behind_rebuilt")
        .when(c("row_offset").isNotNull() & ~c("file_offset").eqNullSafe(c("row_offset")), "file_offset_mismatch_rebuilt").otherwise("resume")
    )
    return seen.withColumn("decision", decision)


def acknowledged_too_far(confirmed: Column, durable: Column) -> Column:
    """Whether the source was told of more than is durable: must never be so."""
    return confirmed > F.coalesce(durable, F.lit(0))


def acknowledgement(seen: DataFrame) -> DataFrame:
    """seen, with decision and ok: the source's confirmed position against the durable one, at start and end. Columns:
    confirmed_flush_lsn, durable_lsn (null: none), snapshot_reads_data (whether the run reads all tables in full anyway)."""
    confirmed, durable = F.col("confirmed_flush_lsn"), F.col("durable_lsn")
    decision = (
        F.when(confirmed.isNull(), "ok").when(durable.isNull() & F.col("snapshot_reads_data"), "no_durable_row_full_snapshot")
        .when(durable.isNull(), "no_durable_destination_row").when(confirmed > durable, "slot_ahead_of_destination").otherwise("ok")
    )
    return seen.withColumn("decision", decision).withColumn("ok", decision.isin("ok", "no_durable_row_full_snapshot"))


def offsets_equal(left: str, right: str) -> Column:
    """Whether two offset maps (map<string, struct<kind, value>>) are the same, types included: 5 isn't "5", and true isn't "true"."""
    entries = lambda m: F.array_sort(F.map_entries(m))
    return entries(left).eqNullSafe(entries(right))


def typed_offsets(text: Column) -> Column:
    """An offset map from JSON with the kind of each value kept: long, boolean or string."""
    raw = F.from_json(text, "map<string,variant>")
    kind = lambda v: F.when(F.schema_of_variant(v) == "BIGINT", "long").when(F.schema_of_variant(v) == "BOOLEAN", "boolean").otherwise("string")
    return F.transform_values(raw, lambda k, v: F.struct(kind(v).alias("kind"), v.cast("string").alias("value")))
