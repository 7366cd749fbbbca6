"""Control state: refusals, audits, recovery journals, slot histories, and what triggers a commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key: an append-only control table as current state."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("l")).select(*keys, "l.*")


def refusals_pending(records: DataFrame) -> DataFrame:
    """Schema refusals whose last record isn't a resolution."""
    return latest(records, ["relation", "refusal"], "at").where("state = 'pending'")


def audited_once(audit: DataFrame, found: DataFrame, identity: list[str]) -> DataFrame:
    """An audit log with new records appended; those it holds already, and repeats, are left out."""
    return audit.unionByName(found.dropDuplicates(identity).join(audit.select(*identity), identity, "left_anti"))


def superseded(changes: DataFrame) -> DataFrame:
    """Queued changes of each relation with what became of them: a later observation of the same kind replaces an earlier one,
    and a relation that is present again cancels its drop."""
    own = Window.partitionBy("relation").orderBy("lsn").rowsBetween(1, Window.unboundedFollowing)
    later = F.collect_set("kind").over(own)
    gone = F.array_contains(later, F.col("kind")) | ((F.col("kind") == "dropped") & (F.size(F.array_intersect(later, F.array(F.lit("present"), F.lit("recreated")))) > 0))
    return changes.withColumn("state", F.when(gone, "superseded").otherwise("pending"))


def journal_step(journal: DataFrame) -> DataFrame:
    """Where each recovery stands and what it does next, from its last durable phase alone."""
    last = latest(journal, ["pipeline"], "at")
    todo = F.create_map(*[F.lit(x) for x in ("requested", "delete_offsets_file", "offsets_file_deleted", "delete_resume_point", "resume_point_deleted", "drop_slot", "armed", "rebuild")])
    return last.select("pipeline", "phase", todo[F.col("phase")].alias("next_step"))


def recovered(states: DataFrame, resume: DataFrame) -> DataFrame:
    """Per pipeline whether its rebuild is finished: every captured table complete, and a resume point, or all of them verified
    empty."""
    per = states.groupBy("pipeline").agg(F.bool_and(F.col("snapshot_state") == "complete").alias("complete"), F.bool_and("verified_empty").alias("empty"))
    rows = per.join(resume.select("pipeline", F.lit(True).alias("has_resume")), "pipeline", "left")
    return rows.select("pipeline", (F.col("complete") & (F.coalesce("has_resume", F.lit(False)) | F.col("empty"))).alias("finished"))


def slot_history(observations: DataFrame) -> DataFrame:
    """Each observation of a slot with the one before it, as the decision table wants them."""
    own = Window.partitionBy("slot").orderBy("at")
    out = observations
    for name in ("restart_lsn", "confirmed_flush_lsn", "system_identifier", "timeline_id"):
        out = out.withColumn(f"prev_{name}", F.lag(name).over(own))
    return out


def steady(samples: DataFrame, most_lag: int) -> DataFrame:
    """Per source since when, without a break up to its last sample, the lag has stayed within bounds."""
    own = Window.partitionBy("source").orderBy("at")
    rows = samples.withColumn("run", F.sum((F.col("lag") > most_lag).cast("int")).over(own))
    rows = rows.withColumn("last_run", F.max("run").over(Window.partitionBy("source"))).where((F.col("run") == F.col("last_run")) & (F.col("lag") <= most_lag))
    return rows.groupBy("source").agg(F.min("at").alias("steady_since"), F.count("*").alias("samples"))


def commit_trigger(groups: DataFrame, age_ms: int = 5000, events: int = 200_000, size: int = 256 << 20) -> DataFrame:
    """What closes each open group: its phase first, then events, size and age; null if nothing does yet."""
    c = F.col
    why = F.when(c("phase_changes"), "phase_change").when(c("events") >= events, "events").when(c("bytes") >= size, "bytes").when(c("age_ms") >= age_ms, "age").when(c("drained"), "drained")
    return groups.withColumn("trigger", why)


def resume_point(units: DataFrame) -> DataFrame:
    """The position to start from again: the last of the whole units (complete) before the first one that isn't; never beyond
    work that is still to be done."""
    first = units.where(~F.col("complete")).agg(F.min("last_lsn").alias("first_open"))  # one row
    units = units.where("complete").join(F.broadcast(first), F.col("first_open").isNull() | (F.col("last_lsn") < F.col("first_open")))
    return units.agg(F.max("last_lsn").alias("last_lsn"), F.max_by("txn_id", "last_lsn").alias("last_txn_id"), F.count("*").alias("units"))


def truncate_effect(removed: DataFrame, mode: str) -> DataFrame:
    """Markers of truncates under a policy: replicated ones remove rows, logged ones only say so, ignored ones leave none."""
    if mode == "ignore":
        return removed.limit(0).withColumn("applied", F.lit(False))
    return removed.withColumn("applied", F.lit(mode == "replicate"))


def telling(before: Column, keys: list[str], placeholder: str) -> Column:
    """A before-image without key columns and unsent values: what can tell rows apart."""
    return F.map_filter(before, lambda k, v: ~k.isin(keys) & ~v.eqNullSafe(F.lit(placeholder)))


def notification(raw: DataFrame) -> DataFrame:
    """Snapshot notifications, typed; an unknown observation is an error, not a guess."""
    kinds = ("STARTED", "IN_PROGRESS", "TABLE_SCAN_COMPLETED", "TABLE_CHUNK_IN_PROGRESS", "TABLE_CHUNK_COMPLETED", "COMPLETED", "SKIPPED", "ABORTED")
    n = F.from_json("value", "observation string, scanned_collection string, total_rows_scanned string, status string", {"mode": "FAILFAST"})
    rows = raw.withColumn("n", n)
    known = F.when(F.col("n.observation").isin(*kinds), F.col("n.observation")).otherwise(F.raise_error(F.concat(F.lit("unknown notification "), F.coalesce("n.observation", F.lit("null")))))
    return rows.select("seq", known.alias("observation"), F.col("n.scanned_collection").alias("src_table"), F.col("n.total_rows_scanned").try_cast("bigint").alias("declared"), F.col("n.status").alias("status"))


def snapshot_phase(notifications: DataFrame, expected: DataFrame) -> DataFrame:
    """Whether a snapshot is complete: it started and completed, and the tables whose scans ended are exactly those expected."""
    ends = notifications.where("observation = 'TABLE_SCAN_COMPLETED'").select("src_table").distinct().withColumn("scanned", F.lit(1))
    odd = expected.withColumn("expected", F.lit(1)).join(ends, "src_table", "full_outer").where("expected IS NULL OR scanned IS NULL").agg(F.count("*").alias("odd"))
    marks = notifications.agg(F.coalesce(F.max((F.col("observation") == "STARTED").cast("int")), F.lit(0)).alias("started"), F.coalesce(F.max((F.col("observation") == "COMPLETED").cast("int")), F.lit(0)).alias("completed"), F.coalesce(F.max((F.col("observation") == "ABORTED").cast("int")), F.lit(0)).alias("aborted"))
    state = F.when(F.col("aborted") == 1, "aborted").when(F.col("started") != 1, "awaiting_callbacks").when(F.col("completed") != 1, "callbacks_started").when(F.col("odd") > 0, "completion_notified").otherwise("callbacks_complete")
    return marks.withColumn("one", F.lit(1)).join(odd.withColumn("one", F.lit(1)), "one").select(state.alias("state"), "odd")  # one row each


def inspected(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Per destination table its rows, operations and last position, and whether its image is complete; tables without rows too."""
    per = rows.groupBy("src_table").agg(
        F.count("*").alias("rows"), *[F.count_if(F.col("op") == op).alias(name) for op, name in (("c", "inserts"), ("u", "updates"), ("d", "deletes"))], F.max("lsn").alias("last_lsn")
    )
    out = per.join(states, "src_table", "full_outer")
    return out.select("src_table", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows", "inserts", "updates", "deletes")], "last_lsn", F.coalesce(F.col("snapshot_state") == "complete", F.lit(False)).alias("complete"))
