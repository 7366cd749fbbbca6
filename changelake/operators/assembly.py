"""Transaction assembly: which source transactions are proven whole, what breaks the stream, and the fences on replayed and
snapshot data.

A stream is a DataFrame of records in order of arrival (seq): kind (data, truncate, txn_begin, txn_end, logical_message,
snapshot, heartbeat), txn_id, total_order, lsn, src_table, snapshot, and, for END records, event_count and data_collections.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranges

CHANGES = ("data", "truncate", "logical_message")


def completeness(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Per transaction: whether its events are as many as declared, numbered exactly 1 to n, and as many per table as
    declared, in both directions. One row per transaction; transactions without END are incomplete."""
    seen = log.groupBy("txn_id").agg(
        F.count("*").alias("events"), F.min("total_order").alias("lo"), F.max("total_order").alias("hi"),
        F.count_distinct("total_order").alias("ordinals"), F.max("lsn").alias("last_lsn"),
    )
    wrong = table_counts(log, ends).where("declared <> observed").select("txn_id").distinct().withColumn("wrong", F.lit(True))
    rows = seen.join(ends.select("txn_id", "event_count"), "txn_id", "left").join(wrong, "txn_id", "left")
    numbered = (F.col("lo") == 1) & (F.col("hi") == F.col("events")) & (F.col("ordinals") == F.col("events"))
    whole = F.coalesce((F.col("event_count") == F.col("events")) & numbered & F.col("wrong").isNull(), F.lit(False))
    return rows.select("txn_id", "events", F.col("event_count").alias("declared"), "last_lsn", whole.alias("complete"))


def table_counts(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Declared and observed events per transaction and table; 0 where one side lacks the table."""
    observed = log.groupBy("txn_id", F.col("event_type").alias("src_table")).agg(F.count("*").alias("observed"))
    declared = ends.select("txn_id", F.explode("data_collections").alias("src_table", "declared"))
    rows = declared.join(observed, ["txn_id", "src_table"], "full_outer")
    return rows.select("txn_id", "src_table", F.coalesce("declared", F.lit(0)).cast("long").alias("declared"), F.coalesce("observed", F.lit(0)).cast("long").alias("observed"))


def proofs(stream: DataFrame) -> DataFrame:
    """One row per transaction of a stream: events, last_lsn (that of END counts), ended, and what its END doesn't prove
    (reason, null if it is whole). Logical messages count and take an ordinal, but belong to no table that must be declared."""
    own = stream.where(F.col("kind").isin(*CHANGES, "txn_end", "txn_begin") & F.col("txn_id").isNotNull())
    change, end = F.col("kind").isin(*CHANGES), F.col("kind") == "txn_end"
    order = F.when(change, F.col("total_order"))
    per = own.groupBy("txn_id").agg(
        F.count_if(change).alias("events"), F.min(order).alias("lo"), F.max(order).alias("hi"), F.count_distinct(order).alias("ordinals"),
        F.max("lsn").alias("last_lsn"), F.max_by("total_order", F.when(change, F.col("seq"))).alias("last_order"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.count_if(end).alias("ends"), F.max(F.when(end, F.col("event_count"))).alias("declared"),
    )
    observed = own.where(F.col("kind").isin("data", "truncate")).groupBy("txn_id", "src_table").agg(F.count("*").alias("observed"))
    declared = own.where(end).select("txn_id", F.explode("data_collections").alias("src_table", "declared"))
    # What is declared beyond the tables seen may be logical messages: as many as there were.
    odd = declared.join(observed, ["txn_id", "src_table"], "full_outer").groupBy("txn_id").agg(
        F.count_if(F.col("observed").isNotNull() & ~F.col("observed").eqNullSafe(F.col("declared"))).alias("wrong"),
        F.coalesce(F.sum(F.when(F.col("observed").isNull(), F.col("declared"))), F.lit(0)).alias("unseen"),
    )
    messages = own.groupBy("txn_id").agg(F.count_if(F.col("kind") == "logical_message").alias("messages"))
    rows = per.join(odd, "txn_id", "left").join(messages, "txn_id")
    numbered = (F.col("events") == 0) | ((F.col("lo") == 1) & (F.col("hi") == F.col("events")) & (F.col("ordinals") == F.col("events")))
    reason = (
        F.when(F.col("ends") == 0, "open").when(F.col("declared").isNull() | (F.col("declared") != F.col("events")), "event count")
        .when(~numbered, "ordinals").when((F.coalesce("wrong", F.lit(0)) > 0) | (F.coalesce("unseen", F.lit(0)) > F.col("messages")), "table counts")
    )
    return rows.select("txn_id", "events", "declared", "last_lsn", "last_order", "first_seq", "last_seq", (F.col("ends") > 0).alias("ended"), reason.alias("reason"))


def faults(stream: DataFrame, parts: int | None = None) -> DataFrame:
    """Records that a serial stream can't hold, with the rule that they break: seq, txn_id, rule. A transaction may open without
    BEGIN, an END may stand alone, and only the last transaction may lack its END."""
    kind, txn = F.col("kind"), F.col("txn_id")
    change = kind.isin(*CHANGES)
    counted = change & ~((kind == "logical_message") & txn.isNull())  # a message outside transactions is a control record
    rows = stream.where(counted | kind.isin("txn_begin", "txn_end", "snapshot"))
    rows = ranges.previous(rows.select("seq", "kind", "txn_id", "total_order", *_optional(stream, "snapshot")), "seq", ["kind", "txn_id"], "before", parts)
    before = F.when(~F.col("before.kind").isin("txn_end", "snapshot"), F.col("before.txn_id"))
    rule = (
        F.when((kind == "snapshot") & (F.lower("snapshot") == "incremental"), "incremental snapshot")
        .when((kind == "snapshot") & before.isNotNull(), "snapshot record inside a transaction")
        .when((kind == "txn_begin") & txn.isNull(), "BEGIN without a transaction id").when((kind == "txn_begin") & before.isNotNull(), "BEGIN while a transaction is open")
        .when(change & txn.isNull(), "no transaction id").when(change & F.col("total_order").isNull(), "no ordinal").when(change & (F.col("total_order") < 1), "ordinal below 1")
        .when(change & before.isNotNull() & (before != txn), "another transaction without END")
        .when((kind == "txn_end") & before.isNotNull() & (before != txn), "END of another transaction")
    )
    broken = rows.select("seq", "txn_id", rule.alias("rule")).where("rule IS NOT NULL")
    again = stream.where(change & txn.isNotNull() & F.col("total_order").isNotNull()).groupBy("txn_id", "total_order").agg(F.count("*").alias("n"), F.max("seq").alias("seq"))
    return broken.unionByName(again.where("n > 1").select("seq", "txn_id", F.lit("ordinal given twice").alias("rule")))


def _optional(rows: DataFrame, *names: str) -> list[Column]:
    return [F.col(n) if n in rows.columns else F.lit(None).cast("string").alias(n) for n in names]


def control_units(stream: DataFrame, parts: int | None = None) -> DataFrame:
    """Records that are units of their own: ENDs that close nothing, and control records outside transactions. One inside an
    open transaction is carried by it, lest it move the resume point."""
    control = F.col("kind").isin("heartbeat", "logical_message") & F.col("txn_id").isNull()
    rows = stream.where(F.col("kind").isin(*CHANGES, "txn_begin", "txn_end", "heartbeat"))
    last = ranges.previous(rows.where(~control), "seq", ["kind", "txn_id"], "before", parts)
    orphans = last.where((F.col("kind") == "txn_end") & (F.col("before").isNull() | F.col("before.kind").isin("txn_end"))).select("seq", "kind", "txn_id", "lsn")
    spans = last.where("kind = 'txn_end'").groupBy("txn_id").agg(F.max("seq").alias("hi"))
    # A transaction without END holds all that follows.
    spans = rows.where(~control).groupBy("txn_id").agg(F.min("seq").alias("lo")).join(spans, "txn_id", "left").select("lo", F.coalesce("hi", F.lit(2**63 - 1)).alias("hi"))
    # Transactions don't overlap, so the one that may hold a record is the last to begin before it: a running maximum.
    marks = spans.select(F.col("lo").alias("seq"), F.struct("lo", "hi").alias("span"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("long").alias("lsn"))
    free = rows.where(control).select("seq", F.lit(None).cast("struct<lo:bigint,hi:bigint>").alias("span"), "kind", "lsn").unionByName(marks)
    free = ranges.spanned(free, "seq", parts)
    top = free.groupBy(ranges.SPAN).agg(F.max("span").alias("most"))
    top = top.select(F.col(ranges.SPAN).alias("__at"), F.max("most").over(Window.partitionBy(F.lit(0)).orderBy(ranges.SPAN).rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    own = F.max("span").over(Window.partitionBy(ranges.SPAN).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    free = free.withColumn("own", own).join(top, F.col(ranges.SPAN) == F.col("__at")).withColumn("holder", F.coalesce("own", "earlier"))
    free = free.where(F.col("kind").isNotNull() & (F.col("holder").isNull() | (F.col("holder.hi") < F.col("seq"))))
    return orphans.unionByName(free.select("seq", "kind", F.lit(None).cast(dict(stream.dtypes)["txn_id"]).alias("txn_id"), "lsn"))


def open_tail(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Events of transactions that have no END: they stay unapplied, and the source's position stays before them."""
    return log.join(ends.select("txn_id"), "txn_id", "left_anti")


def breaks(log: DataFrame) -> DataFrame:
    """Events whose ordinal isn't the one after the event before in their transaction. Positions are bytes of a log, so they
    only grow: gaps between them mean nothing, a step back does."""
    own = Window.partitionBy("txn_id").orderBy("seq")
    rows = log.withColumn("before", F.lag("total_order").over(own)).withColumn("lsn_before", F.lag("lsn").over(own))
    gap = F.col("total_order") != F.coalesce("before", F.lit(0)) + 1
    back = F.coalesce(F.col("lsn") < F.col("lsn_before"), F.lit(False))
    return rows.where(gap | back).select("txn_id", "lsn", "total_order", F.coalesce("before", F.lit(0)).alias("previous_order"), back.alias("steps_back"))


def units(log: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """One row per source transaction: its commit position (that of END, or its last event's if later), tables, and first and
    last event."""
    rows = log.groupBy("txn_id").agg(
        F.max("lsn").alias("last_lsn"), F.count("*").alias("event_count"), F.array_sort(F.collect_set("event_type")).alias("tables"),
        F.min_by("event_type", "lsn").alias("first_table"), F.max_by("event_type", "lsn").alias("last_table"), F.max("ts").alias("max_source_ts"),
    )
    if ends is None:
        return rows
    rows = rows.join(ends.select("txn_id", F.col("lsn").alias("end_lsn")), "txn_id", "left")
    return rows.withColumn("last_lsn", F.greatest("last_lsn", "end_lsn")).drop("end_lsn")


def replay_fence(unit_rows: DataFrame, resume_lsn: int | Column) -> DataFrame:
    """Units marked fenced if the destination already holds them: their last position is at or before the resume point."""
    return unit_rows.withColumn("fenced", F.col("last_lsn") <= (F.lit(resume_lsn) if isinstance(resume_lsn, int) else resume_lsn))


def watermark_fence(log: DataFrame, watermarks: DataFrame, on: str) -> DataFrame:
    """Events that a table's snapshot doesn't already hold. A unit is compared by its commit position, never an event by
    its own; at the watermark or beyond it is applied. watermarks: one row per table."""
    commit = F.max("lsn").over(Window.partitionBy("txn_id"))
    rows = log.withColumn("commit_lsn", commit).join(watermarks, on, "left")
    return rows.where(F.col("snapshot_lsn").isNull() | (F.col("commit_lsn") >= F.col("snapshot_lsn")))


class MixedEpoch(RuntimeError):
    """One unit holds rows of the shape before and after a schema change: it can be applied in neither epoch."""


def schema_epochs(unit_rows: DataFrame, fence_lsn: int, new_shape: Column, old_shape: Column | None = None) -> DataFrame:
    """Units before or after a schema change: by position, unless a row's shape proves the change was already made. A unit
    with rows of both shapes is mixed."""
    after = F.when((F.col("last_lsn") > fence_lsn) | new_shape, "after").otherwise("before")
    return unit_rows.withColumn("epoch", after if old_shape is None else F.when(new_shape & old_shape, "mixed").otherwise(after))


def refuse_mixed(epochs: DataFrame) -> DataFrame:
    """epochs, once none is mixed."""
    found = [r.txn_id for r in epochs.where("epoch = 'mixed'").select("txn_id").limit(5).collect()]
    if found:
        raise MixedEpoch(f"transactions {found} hold rows of both shapes")
    return epochs


def commit_groups(unit_rows: DataFrame, most_events: int, parts: int | None = None) -> DataFrame:
    """unit_rows with commit_id: whole units in order of position, a group closing with the unit that brings it to most_events.

    Where a group closes depends on all before it. Running counts come from two levels; then each span of units tells, for
    every way in which a group may be open at its start, how many groups it closes and what it leaves open. Those answers
    (at most one for each unit of a group's width, a span) are chained in one task, and each span numbers its own units."""
    limit = max(1, most_events)
    rows = ranges.running_sum(unit_rows, [], "last_lsn", F.col("event_count"), "upto", parts)
    rows = ranges.spanned(rows, "last_lsn", parts)

    def closing(upto: np.ndarray) -> np.ndarray:
        """For a group that closes at each unit, where the next one closes."""
        return np.searchsorted(upto, upto + limit)

    def answers(frame):
        import pandas as pd

        frame = frame.sort_values("upto")
        upto = frame["upto"].to_numpy()
        n, following = len(upto), closing(upto)
        closes, leaves = np.ones(n + 1, np.int64), np.zeros(n + 1, np.int64)
        for i in range(n - 1, -1, -1):
            j = following[i]
            closes[i] = 1 + (closes[j] if j < n else 0)
            leaves[i] = leaves[j] if j < n else upto[i] + limit
        first = upto[0] - frame["event_count"].iloc[0]
        few = min(n, int(np.searchsorted(upto, first + limit)) + 1)
        return pd.DataFrame({"span": frame[ranges.SPAN].iloc[0], "upto": upto[:few], "closes": closes[:few], "leaves": leaves[:few], "last": upto[-1]})

    def chain(frame):
        import pandas as pd

        due, done, out = limit, 0, []
        for span, own in frame.sort_values(["span", "upto"]).groupby("span"):
            out.append((span, due, done))
            if due <= own["last"].iloc[0]:
                at = int(np.searchsorted(own["upto"].to_numpy(), due))
                due, done = int(own["leaves"].iloc[at]), done + int(own["closes"].iloc[at])
        return pd.DataFrame(out, columns=["span", "due", "done"])

    def number(frame):
        import pandas as pd

        frame = frame.sort_values("upto")
        upto, due, done = frame["upto"].to_numpy(), int(frame["due"].iloc[0]), int(frame["done"].iloc[0])
        ids, at = np.empty(len(upto), np.int64), 0
        while at < len(upto):
            j = int(np.searchsorted(upto, due))
            ids[at : j + 1] = done + 1
            if j < len(upto):
                due, done = int(upto[j]) + limit, done + 1
            at = j + 1
        return pd.DataFrame({"upto": upto, "commit_id": ids})

    slim = rows.select(F.col(ranges.SPAN).cast("int").alias(ranges.SPAN), "upto", F.col("event_count").cast("long").alias("event_count"))
    told = slim.groupBy(ranges.SPAN).applyInPandas(answers, "span int, upto long, closes long, leaves long, last long")
    entries = told.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(chain, "span int, due long, done long")
    numbered = slim.join(entries, F.col(ranges.SPAN) == F.col("span")).groupBy(ranges.SPAN).applyInPandas(number, "upto long, commit_id long")
    return rows.drop(ranges.SPAN).join(numbered, "upto").drop("upto")


def phases(unit_rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Units with the number of their phase: a commit group never mixes snapshot and streaming units (column is_snapshot)."""
    rows = ranges.previous(unit_rows, "last_lsn", ["is_snapshot"], "before", parts)
    changed = F.coalesce((F.col("before.is_snapshot") != F.col("is_snapshot")).cast("long"), F.lit(0))
    return ranges.running_sum(rows, [], "last_lsn", changed, "phase", parts).drop("before")
