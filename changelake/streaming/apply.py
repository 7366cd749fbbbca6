"""Structured Streaming: a serial change stream applied to a store, exactly once.

A micro-batch may end inside a transaction, so the store keeps the open tail's records in the table `_open`, and the next batch
starts with them: a resume point only ever sits between transactions. Each batch is proven before anything is written:

1. The stream must be serial (assembly.faults) and every transaction but the last proven whole by its END (assembly.proofs).
   A batch that isn't is refused: an alert stays, nothing is written, and the stream stops.
2. Whole transactions at or before the resume point are already durable: they are fenced and counted. Events of a table whose
   image holds their transaction's position are left out, too.
3. Keyed tables take the physical-row fold, with truncates and moves of keys; tables without a key are logs of events.
   Where the fold can't tell rows apart, the batch is refused and new images of its tables are requested.
4. One commit holds all tables, truncate markers, the open tail, the audit row and the resume point. A batch is known by its
   id; one that Spark runs again after a crash is recognised and left alone.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import assembly, fold
from ..store import AmbiguousDelete, Store

OPEN, EVENTS = "_open", "_table_events"
#: Stands for a null in a key's text.
NULL_KEY = "\0null"
#: Records of a change stream in order of arrival; before and row hold the images as text, by column.
RECORD = (
    "seq long, kind string, src_table string, op string, lsn long, txn_id string, total_order long, source_ts_ms long, "
    f"before {fold.ROW}, row {fold.ROW}, event_count long, data_collections map<string,bigint>"
)
META = {"cdcf_commit_id": "bigint", "cdcf_event_id": "string", "cdcf_total_order": "bigint", "dbz_op": "string", "dbz_lsn": "bigint", "dbz_tx_id": "string", "dbz_table": "string", "dbz_source_ts_ms": "bigint"}


class AssemblyError(RuntimeError):
    """The stream isn't a series of whole transactions; nothing of the batch is applied."""


@dataclass(frozen=True)
class Table:
    """A captured table: where it goes, its columns with their types, and its key (none: it becomes a log)."""

    target: str
    columns: dict[str, str]
    keys: tuple[str, ...] = ()
    truncate_mode: str = "replicate"

    @property
    def kinds(self) -> dict[str, str]:
        return {**self.columns, **META}


def bound(image: Column, columns: dict[str, str]) -> Column:
    """An image whose values read as they would in the destination: before-images are compared by value, not by spelling."""
    def value(k: Column, v: Column) -> Column:
        out = F.when(v.eqNullSafe(F.lit(S.UNAVAILABLE)), v)
        for name, kind in columns.items():
            if kind != "string":
                out = out.when(k == name, v.try_cast(kind).cast("string"))
        return out.otherwise(v)

    return F.transform_values(image, value)


def typed(row: Column, kinds: dict[str, str]) -> list[Column]:
    return [F.try_element_at(row, F.lit(c)).try_cast(kind).alias(c) for c, kind in kinds.items()]


def key_of(image: Column, keys: tuple[str, ...]) -> Column:
    """The key as text; null unless the image carries all of it."""
    carried = [F.map_contains_key(image, F.lit(k)) for k in keys]
    whole = carried[0]
    for c in carried[1:]:
        whole = whole & c
    return F.when(whole, F.to_json(F.array(*[F.coalesce(F.try_element_at(image, F.lit(k)), F.lit(NULL_KEY)) for k in keys])))


def operations(events: DataFrame, name: str, table: Table, commit_id: int) -> DataFrame:
    """A keyed table's events as fold.key_operations() wants them; rows carry the applier's columns."""
    before, row = bound(F.col("before"), table.columns), bound(F.col("row"), table.columns)
    event_id = F.concat_ws(":", F.col("lsn").cast("string"), "txn_id", F.col("total_order").cast("string"))
    meta = F.create_map(*[x for k, v in (("cdcf_commit_id", F.lit(str(commit_id))), ("cdcf_event_id", event_id), ("cdcf_total_order", F.col("total_order").cast("string")), ("dbz_op", F.col("op")), ("dbz_lsn", F.col("lsn").cast("string")), ("dbz_tx_id", F.col("txn_id")), ("dbz_table", F.lit(name)), ("dbz_source_ts_ms", F.col("source_ts_ms").cast("string"))) for x in (F.lit(k), v)])
    rows = events.withColumn("before", before).withColumn("row", F.when(F.col("row").isNotNull(), F.map_concat(row, meta)))
    after, old = key_of(F.col("row"), table.keys), key_of(F.col("before"), table.keys)
    return rows.select(
        F.lit(table.target).alias("target"), F.when(F.col("op") == S.DELETE, old).otherwise(after).alias("key"), F.when(F.col("op") == S.UPDATE, old).alias("old_key"),
        "seq", F.col("txn_id").alias("txn"), "op", "before", "row",
    )


def holding(store: Store, table: Table) -> DataFrame | None:
    """The destination's rows as the fold wants them; a table whose shadow is open has that as its destination."""
    entry = store.latest()["shadows"].get(table.target)
    held = store.shadow(table.target) if entry else store.table(table.target)
    if held is None:
        return None
    image = F.create_map(*[x for c in held.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))])
    return held.select(F.lit(table.target).alias("target"), image.alias("row")).withColumn("key", key_of(F.col("row"), table.keys))


def refuse(store: Store, code: str, message: str, kind: type[Exception], tables: list[str] | None = None) -> None:
    store.alert(code, message)
    if tables:
        store.request_image(tables, message)
    raise kind(message)


def apply_batch(store: Store, tables: dict[str, Table], parts: int | None = None):
    """The foreachBatch function for a stream of RECORD."""

    def run(batch: DataFrame, batch_id: int) -> None:
        state, began = store.latest(), time.time()
        if batch_id <= state["batches"]:
            return
        names = [f.split()[0] for f in RECORD.split(", ")]
        tail = store.table(OPEN)
        given = batch.select(*names) if tail is None else tail.select(*names).unionByName(batch.select(*names))
        # A source that starts again sends its open transaction anew: the same records under new numbers.
        rows = (given if tail is None else given.dropDuplicates(["kind", "txn_id", "total_order", "lsn", "src_table", "op"])).persist()
        cached = [rows]
        try:
            broken = assembly.faults(rows, parts).orderBy("seq").limit(3).collect()
            if broken:
                refuse(store, "stream_broken", "; ".join(f"{r.rule} (record {r.seq}, transaction {r.txn_id})" for r in broken), AssemblyError)
            proven = assembly.proofs(rows).persist()
            cached.append(proven)
            wrong = proven.where("ended AND reason IS NOT NULL").limit(3).collect()
            if wrong:
                refuse(store, "incomplete_transaction", "; ".join(f"transaction {r.txn_id}: {r.reason}" for r in wrong), AssemblyError)
            open_ones = proven.where("NOT ended").orderBy("last_seq").collect()  # a serial stream has one at most
            top = proven.agg(F.max("last_seq")).first()[0]
            if len(open_ones) > 1 or open_ones and open_ones[0].last_seq != top:
                refuse(store, "incomplete_transaction", f"transactions {[r.txn_id for r in open_ones]} never ended", AssemblyError)
            resume = state["resume"] or {}
            fence = resume.get("last_lsn", -1)
            units = proven.where("ended").withColumn("fenced", F.col("last_lsn") <= fence)
            stats = units.agg(
                F.count_if(~F.col("fenced")).alias("units"), F.count_if("fenced").alias("fenced"), F.coalesce(F.sum(F.when(~F.col("fenced"), F.col("events"))), F.lit(0)).alias("events"),
                F.coalesce(F.sum(F.when(F.col("fenced"), F.col("events"))), F.lit(0)).alias("fenced_events"), F.max("last_lsn").alias("lsn"), F.min(F.when(~F.col("fenced"), F.col("last_lsn"))).alias("first_lsn"),
                F.max_by("txn_id", "last_seq").alias("last_txn"), F.min_by("txn_id", F.when(~F.col("fenced"), F.col("first_seq"))).alias("first_txn"), F.max_by("last_order", "last_seq").alias("last_order"),
            ).first()
            whole = rows.where(F.col("kind").isin("data", "truncate")).join(units.where("NOT fenced").select("txn_id", F.col("last_lsn").alias("commit_lsn")), "txn_id")
            marks = state["states"]
            for name, table in tables.items():
                mark = marks.get(table.target, {})
                if mark.get("state") == "complete" and mark.get("snapshot_lsn") is not None:
                    whole = whole.where(~((F.col("src_table") == name) & (F.col("commit_lsn") < mark["snapshot_lsn"])))
            strange = [r.src_table for r in whole.select("src_table").distinct().limit(len(tables) + 1).collect() if r.src_table not in tables]
            if strange:
                refuse(store, "uncaptured_table", f"events of {strange}, which no table is configured for", AssemblyError)
            changes, events = {}, None
            for name, table in tables.items():
                own = whole.where(F.col("src_table") == name)
                cuts = own.where(F.col("op") == S.TRUNCATE)
                if table.truncate_mode != "replicate":
                    own = own.where(F.col("op") != S.TRUNCATE)
                if own.isEmpty() and cuts.isEmpty():
                    continue
                change, markers = keyed(store, own, name, table, state["commit_id"] + 1, parts, cached) if table.keys else logged(store, own, name, table, state["commit_id"] + 1)
                if change:
                    changes[table.target] = change
                if table.truncate_mode != "ignore" and not cuts.isEmpty():
                    plain = cuts.select("seq", F.col("txn_id").alias("txn"), F.lit(None).cast("long").alias("rows_removed"))
                    found = (plain if markers is None else markers).select(F.lit("TRUNCATE").alias("event"), F.lit(name).alias("src_table"), F.col("txn").alias("txn_id"), "rows_removed", F.lit(state["commit_id"] + 1).cast("long").alias("commit_id"), F.lit(table.truncate_mode == "replicate").alias("applied"))
                    events = found if events is None else events.unionByName(found)
            if events is not None:
                changes[EVENTS] = {"append": events}
            rest = rows.where(F.col("txn_id").isin([r.txn_id for r in open_ones])) if open_ones else rows.limit(0)
            changes[OPEN] = {"replace": rest}
            point = resume or None
            if stats.lsn is not None and stats.lsn > fence:
                point = {"last_lsn": stats.lsn, "last_txn_id": stats.last_txn, "last_total_order": stats.last_order}
            audit = {
                "event_count": stats.events, "unit_count": stats.units, "fenced_units": stats.fenced, "fenced_events": stats.fenced_events, "first_txn_id": stats.first_txn, "last_txn_id": stats.last_txn,
                "first_lsn": stats.first_lsn, "last_lsn": stats.lsn, "max_source_ts": rows.agg(F.max("source_ts_ms")).first()[0], "trigger": "batch", "opened_at": began,
            }
            store.commit(changes, point, batch_id, audit)
        finally:
            for df in cached:
                df.unpersist()

    return run


def keyed(store: Store, own: DataFrame, name: str, table: Table, commit_id: int, parts: int | None, cached: list[DataFrame]) -> tuple[dict, DataFrame | None]:
    """A keyed table's change, and its truncates with the rows that they removed."""
    ops = operations(own, name, table, commit_id)
    if not ops.where("key IS NULL AND op <> 't'").isEmpty():
        refuse(store, "no_key", f"an event of {name} carries no key", AssemblyError)
    held = holding(store, table)
    none = own.sparkSession.createDataFrame([], f"target string, key string, row {fold.ROW}")
    folded = fold.physical_fold(fold.key_operations(ops, parts=parts), none if held is None else held, list(table.keys)).persist()
    cached.append(folded)
    lost = folded.where("ambiguous IS NOT NULL").limit(3).collect()
    if lost:
        refuse(store, "ambiguous_fold", f"{name}: " + "; ".join(f"{r.key}: {r.ambiguous}" for r in lost), AmbiguousDelete, [table.target])
    markers, truncated = None, not ops.where("op = 't'").isEmpty()
    if truncated:
        markers = fold.rows_removed(folded, fold.cuts(ops), (none if held is None else held).groupBy("target").agg(F.count("*").alias("rows")))
        if held is None and folded.where("action = 'upsert'").isEmpty():
            return {}, markers  # no table is invented for a truncate alone
    upserts = folded.where("action = 'upsert'").select(*typed(F.col("row"), table.kinds))
    gone = F.from_json("key", "array<string>")
    deletes = folded.where("action = 'delete'").select(*[F.when(gone[i] != NULL_KEY, gone[i]).try_cast(table.columns[k]).alias(k) for i, k in enumerate(table.keys)])
    return {"upserts": upserts, "deletes": deletes, "keys": list(table.keys), "truncate": truncated}, markers


def logged(store: Store, own: DataFrame, name: str, table: Table, commit_id: int) -> tuple[dict, DataFrame | None]:
    """A table without a key: one row an event, deletes included, known by the event; a truncate empties it."""
    event_id = F.concat_ws(":", F.col("lsn").cast("string"), "txn_id", F.col("total_order").cast("string"))
    image = F.when(F.col("op") == S.DELETE, F.col("before")).otherwise(F.col("row"))
    meta = [F.lit(commit_id).cast("long").alias("cdcf_commit_id"), event_id.alias("cdcf_event_id"), F.col("total_order").alias("cdcf_total_order"), F.col("op").alias("dbz_op"), F.col("lsn").alias("dbz_lsn"), F.col("txn_id").alias("dbz_tx_id"), F.lit(name).alias("dbz_table"), F.col("source_ts_ms").alias("dbz_source_ts_ms")]
    marked = fold.truncate_epochs(own, F.col("op") == S.TRUNCATE, "seq", ["src_table"])
    rows = marked.where("survives").withColumn("__image", image).select(*typed(F.col("__image"), table.columns), *meta)
    cuts = fold.cuts(own.select(F.lit(table.target).alias("target"), "seq", F.col("txn_id").alias("txn"), "op"))
    if own.where(F.col("op") == S.TRUNCATE).isEmpty():
        return {"append": rows}, None
    before, held = marked.where("NOT is_truncate").groupBy("epoch").agg(F.count("*").alias("own")), store.table(table.target)
    first = 0 if held is None else held.count()
    removed = F.coalesce("own", F.lit(0)) + F.when(F.col("epoch") == 0, first).otherwise(0)
    markers = cuts.join(before, "epoch", "left").withColumn("rows_removed", removed.cast("long"))
    return ({} if held is None and rows.isEmpty() else {"replace": rows}), markers


def follow(changes: DataFrame, store: Store, tables: dict[str, Table], checkpoint: str):
    """Applies what is available and stops: the manifest is written before Spark's own checkpoint of the batch."""
    return changes.writeStream.foreachBatch(apply_batch(store, tables)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bounded(query, seconds: float) -> str:
    """Waits for a bounded run; one that takes longer is stopped, with a bounded wait too. How it ended: work_done, max_seconds
    or hung; a failure of the query is raised."""
    if query.awaitTermination(seconds):
        return "work_done"
    return "max_seconds" if retire(query, seconds) == "closed" else "hung"


def retire(query, seconds: float) -> str:
    """Stops a query on a thread of its own: closed, failed, or abandoned after so many seconds."""
    import threading

    failed: list[BaseException] = []

    def stop() -> None:
        try:
            query.stop()
        except Exception as e:
            failed.append(e)

    thread = threading.Thread(target=stop, daemon=True)
    thread.start()
    thread.join(seconds)
    return "abandoned" if thread.is_alive() else "failed" if failed else "closed"


def unflushed(store: Store, query) -> bool:
    """Whether Spark's checkpoint claims a batch that the store doesn't hold: an acknowledgement without its data."""
    done = (query.lastProgress or {}).get("batchId", -1)
    return done > store.latest()["batches"]


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and type, with late ones counted until the watermark passes."""
    stamped = events.withColumn("at", F.col("ts").cast("timestamp"))
    return stamped.withWatermark("at", late).groupBy(F.window("at", size).alias("w"), "event_type").agg(F.count("*").alias("events"))
