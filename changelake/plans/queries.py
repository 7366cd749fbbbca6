"""One query per operator: each applies it to whole tables and has the same name in oracle.SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import machines, schemas
from ..functions import lattice, naming
from ..operators import assembly, catalog, control, evolution, fold, reconcile, snapshots
from ..sources.changelog import as_stream, change_log, decode, end_records, envelopes, generated, table, txn_ends
from ..store import Store, scratch
from ..streaming import apply

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def literal(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# Sources and projections


@query
def event_identity(spark, sf):
    log = change_log(spark, sf)
    return log.select("lsn", naming.stream_event_id(F.col("lsn"), F.col("txn_id"), F.col("total_order")).alias("event_id"))


@query
def envelope_decode(spark, sf):
    events = decode(envelopes(change_log(spark, sf)), "app")
    after = F.get_json_object("after_json", "$.user_id").cast("long")
    return events.select("kind", "op", "src_table", "lsn", "txn_id", "total_order", after.alias("after_user"), F.get_json_object("key_json", "$.user_id").cast("long").alias("key_user"))


@query
def json_props_decode(spark, sf):
    return change_log(spark, sf).select("lsn", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query
def destination_rows(spark, sf):
    """The row image with the applier's columns, as a destination table holds it."""
    log = change_log(spark, sf)
    return log.select("user_id", "value", F.col("op").alias("dbz_op"), F.col("lsn").alias("dbz_lsn"), F.col("txn_id").alias("dbz_tx_id"), F.col("total_order").alias("cdcf_total_order"), naming.stream_event_id(F.col("lsn"), F.col("txn_id"), F.col("total_order")).alias("cdcf_event_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("dbz_source_ts_ms"))


@query
def identifier_names(spark, sf):
    names = table(spark, sf, "part").select(F.concat("p_type", F.lit(" "), "p_brand").alias("name")).distinct()
    return names.select("name", naming.snake_case_column(F.col("name")).alias("snake"))


@query
def captured_tables(spark, sf):
    """Events of the capture set, and of all tables in discovery mode."""
    log = change_log(spark, sf)
    some = catalog.captured(log, ["click", "purchase"], "event_type").withColumn("mode", F.lit("configured"))
    return some.unionByName(catalog.captured(log, None, "event_type").withColumn("mode", F.lit("discovery"))).groupBy("mode", "event_type").agg(F.count("*").alias("events"))


# Assembly


@query
def txn_completeness(spark, sf):
    log = change_log(spark, sf)
    return assembly.completeness(log, txn_ends(log))


@query
def txn_table_counts(spark, sf):
    log = change_log(spark, sf)
    return assembly.table_counts(log, txn_ends(log)).where("declared <> observed")


@query
def txn_incomplete_tail(spark, sf):
    log = change_log(spark, sf)
    return assembly.open_tail(log, end_records(log)).select("txn_id", "lsn", "total_order")


@query
def ordinal_gap_check(spark, sf):
    """A log that lost every 97th event, with byte positions of which some step back: where the proof sees it."""
    position = F.col("lsn") * 128 - F.when(F.col("lsn") % 89 == 7, 300).otherwise(0)
    return assembly.breaks(change_log(spark, sf).where("lsn % 97 <> 5").withColumn("seq", F.col("lsn")).withColumn("lsn", position))


def damaged_stream(spark, sf):
    """The log as a serial stream with damage: lost ENDs, repeated, absent and impossible ordinals, BEGINs in between, heartbeats."""
    rows = as_stream(change_log(spark, sf), ["user_id", "value"]).where("NOT (kind = 'txn_end' AND txn_id % 50 = 9)")
    order = F.when((F.col("kind") == "data") & (F.col("txn_id") % 50 == 17) & (F.col("total_order") == 3), F.lit(2)).when((F.col("kind") == "data") & (F.col("txn_id") % 50 == 23) & (F.col("total_order") == 1), F.lit(0)).when((F.col("txn_id") % 50 != 31) | (F.col("total_order") != 4), F.col("total_order"))
    rows = rows.withColumn("total_order", order.cast("long")).select("seq", "kind", "txn_id", "total_order", "lsn", "src_table", "op", "event_count", "data_collections")
    begins = rows.where("kind = 'data' AND txn_id % 50 = 40 AND total_order = 5").withColumns({"kind": F.lit("txn_begin"), "seq": F.col("seq") - 1})
    beats = rows.where("kind = 'data' AND (txn_id % 50 = 41 AND total_order = 2 OR txn_id % 50 = 42 AND total_order = 1)").withColumns({"kind": F.lit("heartbeat"), "seq": F.col("seq") - 1, "txn_id": F.lit(None).cast("string")})
    return rows.unionByName(begins).unionByName(beats)


@query
def stream_faults(spark, sf):
    return assembly.faults(damaged_stream(spark, sf), parts=4)


@query
def stream_proofs(spark, sf):
    """What each transaction's END proves."""
    return assembly.proofs(damaged_stream(spark, sf)).select("txn_id", "events", "declared", "last_lsn", "ended", "reason")


@query
def control_units(spark, sf):
    """Records outside transactions; those inside are carried by theirs."""
    return assembly.control_units(damaged_stream(spark, sf).where("NOT (kind = 'txn_begin')"), parts=4)


@query
def unit_statistics(spark, sf):
    log = change_log(spark, sf)
    u = assembly.units(log, end_records(log).withColumn("lsn", F.col("lsn") + F.col("txn_id") % 3))
    return u.select("txn_id", "last_lsn", "event_count", F.array_join("tables", ",").alias("tables"), "first_table", "last_table", "max_source_ts")


@query
def replay_fence(spark, sf):
    """Units at or before the resume point, here two fifths of the log."""
    u = assembly.units(change_log(spark, sf))
    resume = u.agg(F.max("last_lsn")).first()[0] * 2 // 5
    return assembly.replay_fence(u, resume).groupBy("fenced").agg(F.count("*").alias("units"), F.sum("event_count").alias("events"), F.min("last_lsn").alias("lo"), F.max("last_lsn").alias("hi"))


@query
def watermark_fence(spark, sf):
    marks = literal(spark, "event_type string, snapshot_lsn long", [("click", 3000), ("view", 6000), ("error", 0)])
    kept = assembly.watermark_fence(change_log(spark, sf), F.broadcast(marks), "event_type")
    return kept.groupBy("event_type").agg(F.count("*").alias("kept"), F.min("lsn").alias("first_lsn"))


@query
def schema_epoch_split(spark, sf):
    """Units around a schema change in the middle of the log; some prove by their shape that it was made, some are mixed."""
    u = assembly.units(change_log(spark, sf))
    fence = u.agg(F.max("last_lsn")).first()[0] // 2
    out = assembly.schema_epochs(u, fence, F.col("txn_id") % 101 == 3, (F.col("txn_id") % 101 != 3) | (F.col("txn_id") % 7 == 3))
    return out.groupBy("epoch").agg(F.count("*").alias("units"), F.min("last_lsn").alias("lo"), F.max("last_lsn").alias("hi"))


def uneven_units(spark, sf) -> DataFrame:
    """Units of which some are larger than a commit group should be."""
    return assembly.units(change_log(spark, sf)).withColumn("event_count", F.col("event_count") * F.when(F.col("txn_id") % 13 == 5, 100).otherwise(1))


@query
def commit_groups(spark, sf):
    g = assembly.commit_groups(uneven_units(spark, sf), 500, parts=4)
    return g.groupBy("commit_id").agg(F.count("*").alias("units"), F.sum("event_count").alias("events"), F.min("last_lsn").alias("first_lsn"), F.max("last_lsn").alias("last_lsn"))


@query
def phase_groups(spark, sf):
    """Runs of units of one phase: no group mixes snapshot and streaming units."""
    u = assembly.units(change_log(spark, sf)).withColumn("is_snapshot", F.expr("txn_id div 100") % 3 == 0)
    return assembly.phases(u, parts=4).groupBy("phase", "is_snapshot").agg(F.count("*").alias("units"), F.min("last_lsn").alias("lo"), F.max("last_lsn").alias("hi"))


# The fold


@query
def keyed_current_state(spark, sf):
    log = change_log(spark, sf).select("user_id", "lsn", "op", "event_type", "value")
    return fold.last_writer(log, ["user_id"]).select("user_id", "lsn", "op", "event_type", "value")


def well_formed(spark, sf) -> DataFrame:
    """The log with operations made consistent per key: the first event, and any after a delete, inserts."""
    log = change_log(spark, sf)
    own = Window.partitionBy("user_id").orderBy("lsn")
    gone = F.coalesce(F.lag("op").over(own) == "d", F.lit(True))
    # Two deletes in a row: the second finds nothing, and stays a delete.
    op = F.when(F.col("op") == "d", "d").when(gone, "c").otherwise("u")
    return log.withColumn("op", op)


@query
def physical_row_fold(spark, sf):
    """The full state machine over a well-formed log equals the last writer of each key."""
    log = well_formed(spark, sf)
    image = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("lsn"), F.col("lsn").cast("string"))
    ops = log.select(F.lit("app_users").alias("target"), F.col("user_id").cast("string").alias("key"), F.lit(None).cast("string").alias("old_key"), F.col("lsn").alias("seq"), F.col("txn_id").alias("txn"), "op", F.when(F.col("op") == "d", image).alias("before"), F.when(F.col("op") != "d", image).alias("row"))
    held = literal(spark, f"target string, key string, row {fold.ROW}", [("app_users", "7", {"user_id": "7", "lsn": "-1"}), ("app_users", "none", {"user_id": "none", "lsn": "-1"})])
    out = fold.physical_fold(fold.key_operations(ops), held, ["user_id"])
    return out.select(F.col("key").cast("long").alias("user_id"), "action", F.col("row")["lsn"].cast("long").alias("lsn"), "ambiguous")


#: Scenarios of the fold: name, rows held before (key: value), and operations (txn, op, key, value); a truncate has no key.
SCENARIOS = [
    ("deferred permutation", {"1": "a", "2": "b"}, [(1, "d", "1", "a"), (1, "c", "2", "a"), (1, "d", "2", "b"), (1, "c", "3", "b")]),
    ("chain", {"1": "a"}, [(1, "d", "1", "a"), (1, "c", "2", "a"), (1, "d", "2", "a"), (1, "c", "3", "a")]),
    ("two transactions", {"1": "a"}, [(1, "c", "2", "b"), (2, "d", "1", "a"), (2, "c", "2", "a"), (2, "d", "2", "b"), (2, "c", "3", "b")]),
    ("two rows wear one key", {"1": "a", "2": "b"}, [(1, "d", "1", "a"), (1, "c", "3", "a"), (1, "d", "2", "b"), (1, "c", "3", "b"), (1, "d", "3", "a")]),
    ("untouched row keeps its origin", {"1": "a", "2": "b"}, [(1, "d", "1", "a"), (1, "c", "2", "a"), (1, "d", "2", "a"), (1, "c", "5", "a")]),
    ("unattributable delete", {"1": "a", "2": "b"}, [(1, "d", "1", "a"), (1, "c", "3", "a"), (1, "d", "2", "b"), (1, "c", "3", "b"), (1, "d", "3", "z")]),
    ("key-only delete", {"1": "a"}, [(1, "c", "5", "new"), (1, "d", "5", None)]),
    ("truncate then insert and delete", {"5": "old", "6": "other"}, [(1, "t", None, None), (1, "c", "5", "new"), (1, "d", "5", "new")]),
    ("truncate then key move", {"1": "pre", "9": "other"}, [(1, "c", "3", "c"), (1, "t", None, None), (1, "c", "1", "z"), (1, "d", "1", "z"), (1, "c", "2", "z")]),
    ("reuse then truncate", {"5": "old"}, [(1, "c", "5", "mid"), (1, "d", "5", "mid"), (1, "t", None, None), (1, "c", "5", "final")]),
    ("insert around a truncate", {"1": "x", "2": "y", "3": "z"}, [(1, "c", "60", "p"), (1, "t", None, None), (1, "c", "61", "q")]),
    ("two rows at the end", {"4": "a"}, [(1, "c", "4", "b"), (2, "c", "4", "c")]),
]


@query
def fold_scenarios(spark, sf):
    """The final rows of each scenario, or its refusal."""
    ops, held = [], []
    for name, rows, steps in SCENARIOS:
        held += [(name, k, {"id": k, "v": v}) for k, v in rows.items()]
        for seq, (txn, op, key, value) in enumerate(steps):
            image = None if key is None else {"id": key} | ({"v": value} if value is not None else {})
            ops.append((name, key, None, seq, txn, op, image if op == "d" else None, image if op == "c" else None))
    log = literal(spark, f"target string, key string, old_key string, seq long, txn long, op string, before {fold.ROW}, row {fold.ROW}", ops)
    start = literal(spark, f"target string, key string, row {fold.ROW}", held)
    out = fold.physical_fold(fold.key_operations(log), start, ["id"])
    refused = out.where("ambiguous IS NOT NULL").select("target").distinct()
    cleared = log.where("op = 't'").select("target").distinct()
    kept = start.join(cleared, "target", "left_anti").select("target", "key", F.col("row")["v"].alias("v"))
    touched = out.where("action <> 'keep'").select("target", "key")
    final = kept.join(touched, ["target", "key"], "left_anti").unionByName(out.where("action = 'upsert'").select("target", "key", F.col("row")["v"].alias("v")))
    fine = final.join(refused, "target", "left_anti")
    return fine.unionByName(refused.select("target", F.lit("refused").alias("key"), F.lit(None).cast("string").alias("v"))).select(F.col("target").alias("scenario"), "key", "v")


@query
def pk_update_move(spark, sf):
    """Updates that change the key: the old key goes, the new one comes."""
    image = F.create_map(F.lit("total"), F.col("o_totalprice").cast("string"))
    log = table(spark, sf, "orders").select(F.lit("orders").alias("target"), (F.col("o_orderkey") + 1000000).cast("string").alias("key"), F.col("o_orderkey").cast("string").alias("old_key"), F.col("o_orderkey").alias("seq"), F.lit(1).cast("long").alias("txn"), F.lit("u").alias("op"), F.lit(None).cast(fold.ROW).alias("before"), image.alias("row"))
    return fold.key_operations(log).groupBy("kind").agg(F.count("*").alias("ops"), F.min(F.col("key").cast("long")).alias("lo"), F.max(F.col("key").cast("long")).alias("hi"))


@query
def keyless_changelog(spark, sf):
    """A table without a key is a log: one row per event, deletes included, identified by the event; events sent twice stay once."""
    rows = table(spark, sf, "lineitem").withColumn("n", F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long"), F.col("l_shipdate").cast("date").cast("string")))
    event = lambda op: [*("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.lit(op).alias("dbz_op"), F.concat_ws(":", "n", F.lit(op)).alias("cdcf_event_id")]
    events = rows.select(*event("c")).unionByName(rows.where("l_returnflag = 'R'").select(*event("d")))
    return events.unionByName(rows.where("l_linenumber = 1").select(*event("c"))).dropDuplicates(["cdcf_event_id"])


def with_truncates(spark, sf) -> tuple[DataFrame, object]:
    return change_log(spark, sf), F.col("lsn") % 997 == 500


@query
def truncate_survivors(spark, sf):
    log, cut = with_truncates(spark, sf)
    rows = fold.truncate_epochs(log, cut, "lsn", ["event_type"])
    return rows.where("survives").select("event_type", "lsn", "user_id")


@query
def truncate_rows_removed(spark, sf):
    """What each truncate of four tables removed: the group's rows that were live, and for a table's first what it held before."""
    log, image = well_formed(spark, sf), F.create_map(F.lit("user_id"), F.col("user_id").cast("string"))
    target = lambda n: F.concat(F.lit("users_"), (n % 4).cast("string"))
    none = F.lit(None).cast("string")
    ops = log.select(target(F.col("user_id")).alias("target"), F.col("user_id").cast("string").alias("key"), none.alias("old_key"), (F.col("lsn") * 2).alias("seq"), F.col("txn_id").alias("txn"), "op", F.when(F.col("op") == "d", image).alias("before"), F.when(F.col("op") != "d", image).alias("row"))
    cuts = log.where("lsn % 997 = 500").select(target(F.expr("lsn div 997")).alias("target"), none.alias("key"), none.alias("old_key"), (F.col("lsn") * 2 + 1).alias("seq"), F.col("txn_id").alias("txn"), F.lit("t").alias("op"), F.lit(None).cast(fold.ROW).alias("before"), F.lit(None).cast(fold.ROW).alias("row"))
    ops = ops.unionByName(cuts)
    held = table(spark, sf, "customer").groupBy(target(F.col("c_custkey")).alias("target")).agg(F.count("*").alias("rows"))
    empty = literal(spark, f"target string, key string, row {fold.ROW}", [])
    folded = fold.physical_fold(fold.key_operations(ops, parts=4), empty, ["user_id"])
    return fold.rows_removed(folded, fold.cuts(ops), held).select("target", "seq", "epoch", "rows_removed")


@query
def batched_apply(spark, sf):
    """The whole log through the stream's applier in three batches that cut transactions apart, into a store; then its table."""
    log = well_formed(spark, sf)
    store = Store(spark, scratch(spark, "batched"))
    run = apply.apply_batch(store, {"app.users": apply.Table("users", {"user_id": "bigint", "value": "double"}, ("user_id",))}, parts=2)
    records = as_stream(log, ["user_id", "value"])
    third = log.agg(F.max("lsn")).first()[0] * 4 // 3 + 1
    for k in range(3):
        run(records.where((F.col("seq") >= k * third) & (F.col("seq") < (k + 1) * third)), k)
    return store.table("users").select("user_id", "value", "cdcf_event_id", "dbz_lsn")


@query
def null_safe_delete(spark, sf):
    rows = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"), F.col("c_nationkey").alias("nation"), "c_custkey")
    keys = rows.where("c_custkey % 5 = 0 AND nation < 8").select("seg", "nation").distinct()
    return fold.delete_keys(rows, keys, ["seg", "nation"])


@query
def merge_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = orders.where("o_orderkey % 9 = 1").withColumn("o_orderstatus", F.lit("X")).unionByName(orders.where("o_orderkey % 1000 = 7").select((F.col("o_orderkey") + 10000000).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus")))
    removed = orders.where("o_orderkey % 9 = 2").select("o_orderkey")
    return fold.merge(orders, changed, removed, ["o_orderkey"])


@query
def identity_duplicates(spark, sf):
    return fold.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# Types and schema evolution


def mixed_json(spark, sf) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    n = F.col("lsn") % 5
    text = F.when(n == 0, F.concat(F.lit('{"a": '), k, F.lit(', "b": '), k, F.lit(', "c": true}'))).when(n == 1, F.concat(F.lit('{"a": '), k, F.lit(', "b": '), k, F.lit('.5, "c": null}')))
    text = text.when(n == 2, F.concat(F.lit('{"a": null, "b": 1, "c": false, "d": "x'), k, F.lit('"}'))).when(n == 3, F.lit('{"a": 4, "e": {"z": 1}, "d": 7}')).otherwise(F.lit('{"e": [1, 2], "f": null}'))
    return change_log(spark, sf).select("lsn", "event_type", text.alias("js"))


@query
def type_inference(spark, sf):
    """The destination type of each column, widened over all its values."""
    rows = mixed_json(spark, sf)
    cols = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), lattice.inferred(F.col("js"), f"$.{c}").alias("kind")) for c in "abcdef"])).alias("x")
    per = rows.select(cols).groupBy("x.column_name").agg(F.collect_set("x.kind").alias("kinds"))
    return per.select("column_name", F.coalesce(lattice.widened(F.col("kinds")), F.lit("unknown")).alias("kind"))


@query
def bind_values(spark, sf):
    raw = change_log(spark, sf).select("lsn", F.when(F.col("lsn") % 6 == 0, "true").when(F.col("lsn") % 6 == 1, "T").when(F.col("lsn") % 6 == 2, F.col("lsn").cast("string")).when(F.col("lsn") % 6 == 3, F.concat(F.col("lsn").cast("string"), F.lit(".5"))).when(F.col("lsn") % 6 == 4, "oops").alias("raw"))
    return raw.select("lsn", lattice.bound(F.col("raw"), "BOOLEAN").alias("as_boolean"), F.when(~F.col("raw").contains("."), lattice.bound(F.col("raw"), "BIGINT")).alias("as_bigint"), F.when(F.col("lsn") % 6 > 1, lattice.bound(F.col("raw"), "DOUBLE")).alias("as_double"))


OLD_COLUMNS = [(1, "id", "bigint"), (2, "name", "text"), (3, "city", "text"), (4, "zip", "text"), (6, "note", "text")]
NEW_COLUMNS = [(1, "id", "bigint"), (2, "full_name", "text"), (4, "zip", "integer"), (5, "email", "text"), (6, "city", "jsonb")]


@query
def column_diff(spark, sf):
    schema = "attnum int, name string, type string"
    diff = evolution.column_diff(literal(spark, schema, OLD_COLUMNS), literal(spark, schema, NEW_COLUMNS))
    return diff.join(evolution.application_order(diff).select("attnum", "step"), "attnum")


@query
def source_types(spark, sf):
    names = ["smallint", "integer", "bigint", "real", "double precision", "numeric(30,10)", "numeric", "boolean", "character(4)", "character varying(8)", "text", "bytea", "date", "time without time zone", "interval", "uuid", "json", "jsonb", "integer[]", "inet", "money", "point"]
    return literal(spark, "formatted string", [(n,) for n in names]).select("formatted", lattice.source_type(F.col("formatted")).alias("kind"))


@query
def add_column_backfill(spark, sf):
    held = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    source = table(spark, sf, "orders").where("o_orderkey % 4 <> 0").select("o_orderkey", "o_orderpriority")
    return evolution.backfilled(held, source, ["o_orderkey"], ["o_orderpriority"])


@query
def keyless_uniform_backfill(spark, sf):
    """Columns added to a table without a key: filled in where one value holds throughout, refused where not."""
    rows = table(spark, sf, "lineitem").withColumns({"added": F.lit("v1"), "empty": F.lit(None).cast("string")})
    return evolution.uniform_constants(rows, ["l_returnflag", "added", "empty"])


@query
def rename_merge(spark, sf):
    """Rows written under the old name, and some under the new one, of which some hold an explicit null."""
    rows = change_log(spark, sf).select("lsn", F.when(F.col("lsn") % 3 != 0, F.col("event_type")).alias("old_kind"), F.when(F.col("lsn") % 12 == 0, F.lit("late")).alias("new_kind"))
    carried = rows.where("lsn % 3 = 0").select("lsn")
    return evolution.renamed(rows, "old_kind", "new_kind", carried, "lsn")


@query
def column_presence(spark, sf):
    found = evolution.presence(mixed_json(spark, sf), F.col("event_type"), "lsn", "js")
    return found.groupBy("target", "column_name").agg(F.count("*").alias("events"))


@query
def unexplained_fields(spark, sf):
    return evolution.backfill_missing(evolution.presence(mixed_json(spark, sf), F.col("event_type"), "lsn", "js"), ["a", "b", "c", "d"])


# Snapshots


@query
def snapshot_ordinal(spark, sf):
    rows = change_log(spark, sf).select(F.col("event_type").alias("src_table"), "lsn")
    return snapshots.ordinals(rows, "src_table", "lsn", parts=4).select("src_table", "lsn", F.col("ordinal").cast("long").alias("ordinal"))


@query
def snapshot_chunks(spark, sf):
    rows = change_log(spark, sf).select(F.col("event_type").alias("src_table"), "lsn", F.octet_length("props").alias("nbytes"))
    return snapshots.chunks(snapshots.ordinals(rows, "src_table", "lsn", parts=4), 300, 2000, parts=4)


@query
def snapshot_event_ids(spark, sf):
    rows = snapshots.ordinals(change_log(spark, sf).select(F.col("event_type").alias("src_table"), "lsn"), "src_table", "lsn", parts=4)
    return rows.select("lsn", naming.snapshot_event_id(F.lit(3), F.lit("app"), F.col("src_table"), F.col("ordinal")).alias("event_id"))


@query
def snapshot_completion_counts(spark, sf):
    log = change_log(spark, sf)
    committed = log.where("event_type <> 'view'").groupBy(F.col("event_type").alias("src_table")).agg(F.count("*").alias("committed"))
    declared = log.where("event_type <> 'error'").groupBy(F.col("event_type").alias("src_table")).agg((F.count("*") + F.when(F.col("src_table") == "click", 1).otherwise(0)).alias("declared"))
    return snapshots.completion(declared, committed)


@query
def verified_empty(spark, sf):
    rows = [("a", True, 0, 0, 10), ("b", True, 5, 5, 11), ("c", True, 0, 3, 12), ("d", False, 0, 0, 13), ("e", True, 0, None, 14)]
    return snapshots.verified_empty(literal(spark, "src_table string, scan_completed boolean, records long, source_rows long, sampled_lsn long", rows))


@query
def shadow_swap_state(spark, sf):
    live = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return snapshots.swapped(live, live.where("c_custkey % 3 <> 0"), 4)


STATES = [("click", "complete"), ("view", "in_progress"), ("error", "awaiting_snapshot"), ("signup", "none")]


@query
def recovery_owed(spark, sf):
    """Captured tables that are owed an image, and those whose image isn't finished."""
    captured = change_log(spark, sf).select(F.col("event_type").alias("src_table")).distinct()
    states = literal(spark, "src_table string, snapshot_state string", STATES)
    return snapshots.owed(captured, states).withColumn("why", F.lit("owed")).unionByName(snapshots.unfinished(captured, states).withColumn("why", F.lit("unfinished")))


@query
def source_missing_policy(spark, sf):
    rows = [("done", True, True, True, False, 9), ("there", False, False, True, True, 9), ("gone", False, True, True, False, 9), ("running", False, True, False, False, 9), ("seen", False, True, True, True, 9), ("nowhere", False, True, True, False, None)]
    tables = literal(spark, "src_table string, done boolean, missing boolean, phase_ended boolean, seen boolean, wal_lsn long", rows)
    out = [snapshots.source_missing(tables, mode).withColumn("mode", F.lit(mode)) for mode in ("replicate", "log", "ignore")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def consistent_point(spark, sf):
    """Per table two readings of its image's position: the log's own, and one that some tables see differently."""
    per = change_log(spark, sf).groupBy(F.col("user_id").alias("image")).agg(F.max("lsn").alias("record_lsn"))
    return snapshots.consistent_point(per.withColumn("slot_lsn", F.when(F.col("image") % 5 != 0, F.col("record_lsn") + (F.col("image") % 7 == 0).cast("long"))))


@query
def interrupted_snapshots(spark, sf):
    return snapshots.promote_interrupted(literal(spark, "src_table string, snapshot_state string", STATES))


# Catalog


RELATION = "schema string, table string, oid long, reltype_oid long, published boolean, columns string"
KNOWN = [("app", "a", 1, 10, True, "x"), ("app", "b", 2, 20, True, "x"), ("app", "c", 3, 30, True, "x"), ("app", "d", 4, 40, True, "x"), ("app", "e", 5, 50, False, "x"), ("gone", "f", 6, 60, True, "x"), ("app", "g", 7, 70, True, "x")]
SEEN = [("app", "a", 1, 10, True, "x"), ("app", "b", 22, 21, True, "x"), ("app", "d", 4, 40, False, "x"), ("app", "e", 5, 50, True, "x"), ("app", "g", 7, 70, True, "x,y"), ("app", "h", 8, 80, True, "x")]


@query
def catalog_changes(spark, sf):
    seen = literal(spark, RELATION, SEEN)
    schemas = literal(spark, "schema string", [("app",), ("gone",)])
    return catalog.compare(literal(spark, RELATION, KNOWN), seen, catalog.schema_liveness(schemas, seen))


@query
def schema_liveness(spark, sf):
    return catalog.schema_liveness(literal(spark, "schema string", [("app",), ("gone",)]), literal(spark, RELATION, SEEN))


@query
def confirm_streak(spark, sf):
    """Every user's hourly event type as a poll of a relation's shape."""
    polls = change_log(spark, sf).select(F.col("user_id").alias("relation"), F.expr("lsn div 150").alias("poll"), F.col("event_type").alias("shape")).groupBy("relation", "poll").agg(F.min("shape").alias("shape"))
    return catalog.confirmed(polls, 2)


@query
def mass_drop_breaker(spark, sf):
    kind = F.when((F.col("event_type") == "error") & (F.col("lsn") % 2 == 0), "dropped").when((F.col("event_type") == "signup") & (F.col("lsn") % 3 == 0), "recreated").otherwise("schema")
    return catalog.circuit_breaker(change_log(spark, sf).select(F.col("txn_id").alias("plan_id"), "lsn", kind.alias("kind")), 1)


@query
def catalog_plan(spark, sf):
    """One relation a user: changes due at half of the log, drops deferred where an image is owed, refused if there are too many."""
    log = change_log(spark, sf)
    kind = F.when(F.col("event_type") == "error", "dropped").when(F.col("event_type") == "signup", "new").otherwise("schema")
    changes = log.groupBy(F.col("user_id").cast("string").alias("table")).agg(F.max("lsn").alias("detected_lsn"), F.max_by(kind, "lsn").alias("kind"))
    owed = changes.where("cast(table AS long) % 3 = 0").select("table")
    durable = log.agg(F.max("lsn")).first()[0] - 60
    out = [catalog.plan(changes, durable, owed, mode, allow=allow).withColumn("mode", F.lit(f"{mode} {allow}")) for mode, allow in (("replicate", False), ("replicate", True), ("log", False))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def publication_admissions(spark, sf):
    rows = [("child", True, False, False, None), ("ours", False, False, False, None), ("theirs", False, True, False, None), ("every", False, False, True, None), ("failed", False, False, False, "no right")]
    seen = literal(spark, "table string, is_partition boolean, published boolean, all_tables boolean, error string", rows)
    return catalog.admissions(seen, "own").withColumn("ownership", F.lit("own")).unionByName(catalog.admissions(seen, "external").withColumn("ownership", F.lit("external")))


@query
def identity_metadata(spark, sf):
    """Key columns in the key's order, whatever the columns' own."""
    constraints = literal(spark, "table string, position int, column_id int", [("a", 2, 1), ("a", 1, 3), ("b", 1, 2)])
    return catalog.identities(constraints, literal(spark, "table string, column_id int, name string", [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("b", 2, "k")]))


@query
def lsn_fence(spark, sf):
    """Changes that are due once a third of the log is durable; with grace, those a little beyond it, too."""
    log = change_log(spark, sf)
    durable = log.agg(F.max("lsn")).first()[0] // 3
    changes = log.select(F.col("user_id").alias("relation"), F.col("lsn").alias("detected_lsn"))
    return catalog.due(changes, durable).withColumn("grace", F.lit(0)).unionByName(catalog.due(changes, durable, 64).withColumn("grace", F.lit(64)))


@query
def unrelatable_relations(spark, sf):
    log = change_log(spark, sf)
    counts = log.groupBy(F.col("user_id").alias("relation")).agg(F.count("*").alias("rows"))
    return catalog.unrelatable(counts.select("relation"), counts.where("relation % 4 <> 1").select("relation"), counts)


@query
def column_lists(spark, sf):
    rows = [(s, t, n, f"col{n}", k) for s, t, k in (("app", "a", "bigint"), ("app", "b", "text")) for n in (3, 1, 2)]
    return catalog.column_lists(literal(spark, "schema string, table string, attnum int, name string, type string", rows))


# Reconciliation


SLOT = "name string, observable boolean, durable_lsn long, slot_exists boolean, restart_lsn long, confirmed_flush_lsn long, current_wal_lsn long, system_identifier string, timeline_id int, prev_restart_lsn long, prev_confirmed_flush_lsn long, prev_system_identifier string, prev_timeline_id int, destination_rows long"
SLOTS = [
    ("dark", False, 10, True, 1, 1, 20, "s", 1, 1, 1, "s", 1, 0), ("fresh", True, None, False, None, None, 20, "s", 1, None, None, None, None, None),
    ("unpositioned", True, None, True, 5, None, 20, "s", 1, None, None, None, None, 3), ("populated", True, None, True, 5, 6, 20, "s", 1, None, None, None, None, 3),
    ("empty", True, None, True, 5, 6, 20, "s", 1, None, None, None, None, 0), ("unseen", True, None, True, 5, 6, 20, "s", 1, None, None, None, None, None),
    ("clone", True, 10, True, 5, 6, 20, "s2", 1, 5, 6, "s", 1, 9), ("fork", True, 10, True, 5, 6, 20, "s", 2, 5, 6, "s", 1, 9),
    ("rewound", True, 30, True, 5, 6, 20, "s", 1, 5, 6, "s", 1, 9), ("dropped", True, 10, False, None, None, 20, "s", 1, 5, 6, "s", 1, 9),
    ("remade", True, 10, True, 2, 3, 20, "s", 1, 5, 6, "s", 1, 9), ("crashed", True, 10, True, 2, 8, 20, "s", 1, 5, 6, "s", 1, 9),
    ("ahead", True, 10, True, 5, 15, 20, "s", 1, 5, 6, "s", 1, 9), ("fine", True, 10, True, 5, 10, 20, "s", 1, 5, 6, "s", 1, 9),
    ("first look", True, 10, True, 5, 10, 20, "s", 1, None, None, None, None, 9),
]


@query
def slot_verdicts(spark, sf):
    return reconcile.slot_verdicts(literal(spark, SLOT, SLOTS)).select("name", "verdict", "action")


OFFSET = "name string, file_present boolean, file_decodes boolean, file_lsn long, file_offset string, row_present boolean, row_lsn long, row_offset string, accept_orphan boolean, repair boolean"
OFFSETS = [
    ("nothing", False, False, None, None, False, None, None, False, True), ("orphan", True, True, 5, "o", False, None, None, False, True), ("orphan accepted", True, True, 5, "o", False, None, None, True, True),
    ("no file", False, False, None, None, True, 5, "o", False, True), ("no file, no repair", False, False, None, None, True, 5, "o", False, False), ("no file, no offset", False, False, None, None, True, 5, None, False, True),
    ("corrupt", True, False, None, None, True, 5, "o", False, True), ("ahead", True, True, 9, "x", True, 5, "o", False, True), ("behind", True, True, 3, "x", True, 5, "o", False, True),
    ("same position, other map", True, True, 5, "x", True, 5, "o", False, True), ("agrees", True, True, 5, "o", True, 5, "o", False, True), ("nothing to compare", True, True, 5, "x", True, 5, None, False, True),
]


@query
def offset_decisions(spark, sf):
    return reconcile.offset_decisions(literal(spark, OFFSET, OFFSETS)).select("name", "decision")


@query
def state_reachability(spark, sf):
    """States that no legal edge leads away from, over all machines."""
    t = machines.transitions(spark).where("before <> after")
    ends = t.select("machine", F.col("after").alias("state")).distinct()
    return ends.join(t.select("machine", F.col("before").alias("state")), ["machine", "state"], "left_anti")


# Audits


@query
def commit_log_stats(spark, sf):
    g = assembly.commit_groups(uneven_units(spark, sf), 500, parts=4)
    rows = change_log(spark, sf).join(g.select("txn_id", "commit_id"), "txn_id")
    return rows.groupBy("commit_id").agg(F.count("*").alias("event_count"), F.count_distinct("txn_id").alias("txns"), F.min_by("txn_id", "lsn").alias("first_txn"), F.max_by("txn_id", "lsn").alias("last_txn"), F.min("lsn").alias("first_lsn"), F.max("lsn").alias("last_lsn"), F.max("ts").alias("max_source_ts"))


@query
def ledger_balance(spark, sf):
    """Commits are numbered without gaps, their positions never fall, and their events add up to the source's."""
    g = assembly.commit_groups(uneven_units(spark, sf), 500, parts=4)
    c = g.groupBy("commit_id").agg(F.sum("event_count").alias("events"), F.max("last_lsn").alias("lsn"))
    own = Window.orderBy("commit_id")
    c = c.withColumn("gap", F.col("commit_id") - F.lag("commit_id", 1, 0).over(own) - 1).withColumn("falls", (F.col("lsn") < F.lag("lsn", 1, -1).over(own)).cast("int"))
    return c.agg(F.count("*").alias("commits"), F.sum("events").alias("events"), F.sum("gap").alias("gaps"), F.sum("falls").cast("long").alias("falls"))


@query
def one_commit_per_txn(spark, sf):
    g = assembly.commit_groups(uneven_units(spark, sf), 500, parts=4)
    per = g.groupBy("txn_id").agg(F.count_distinct("commit_id").alias("commits"))
    return per.groupBy("commits").agg(F.count("*").alias("txns"))


@query
def op_histogram(spark, sf):
    return change_log(spark, sf).groupBy("op").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("keys"))


@query
def no_row_lost(spark, sf):
    """Positions of the source's series that the destination lacks."""
    log = change_log(spark, sf)
    top = log.agg(F.max("lsn")).first()[0]
    series = spark.range(0, (-1 if top is None else top) + 1).withColumnRenamed("id", "lsn")
    return series.join(log.where("lsn % 97 <> 5"), "lsn", "left_anti")


@query
def applied_counts(spark, sf):
    return change_log(spark, sf).groupBy("event_type").agg(F.count("*").alias("applied"), F.sum(F.when(F.col("op") == "d", 1).otherwise(0)).cast("long").alias("deletes"))


# Control state


@query
def refusals_pending(spark, sf):
    records = change_log(spark, sf).select(F.col("user_id").alias("relation"), (F.col("lsn") % 3).alias("refusal"), F.col("lsn").alias("at"), F.when(F.col("event_type") == "error", "pending").otherwise("resolved").alias("state"))
    return control.refusals_pending(records)


@query
def snapshot_audit(spark, sf):
    """Completion records delivered in two parts that overlap: each stays once."""
    log = change_log(spark, sf).select("event_type", "txn_id", F.lit("completed").alias("event"))
    return control.audited_once(log.where("txn_id % 3 <> 0").distinct(), log.where("txn_id % 3 <> 1"), ["event_type", "txn_id", "event"])


@query
def superseded_changes(spark, sf):
    kind = F.when(F.col("event_type") == "error", "dropped").when(F.col("event_type") == "signup", "present").when(F.col("event_type") == "click", "recreated").otherwise("schema")
    return control.superseded(change_log(spark, sf).select(F.col("user_id").alias("relation"), "lsn", kind.alias("kind"))).groupBy("relation", "kind", "state").agg(F.count("*").alias("changes"), F.max("lsn").alias("last_lsn"))


@query
def recovery_journal(spark, sf):
    rows = [("p", "requested", 1), ("p", "offsets_file_deleted", 2), ("q", "requested", 1), ("r", "armed", 9), ("r", "requested", 3), ("s", "resume_point_deleted", 4)]
    return control.journal_step(literal(spark, "pipeline string, phase string, at long", rows))


@query
def recovery_finished(spark, sf):
    states = [("p", "a", "complete", False), ("p", "b", "complete", False), ("q", "a", "complete", True), ("q", "b", "complete", True), ("r", "a", "complete", False), ("s", "a", "awaiting_snapshot", False)]
    return control.recovered(literal(spark, "pipeline string, src_table string, snapshot_state string, verified_empty boolean", states), literal(spark, "pipeline string, last_lsn long", [("p", 1), ("s", 2)]))


@query
def slot_history(spark, sf):
    """Observations in a row, decided by the table: a slot that falls back was made anew. All of the log is durable, however long."""
    log = change_log(spark, sf)
    end = log.agg(F.greatest(F.max("lsn"), F.lit(0)).alias("end_lsn"))  # one row
    seen = log.select(F.col("user_id").alias("slot"), F.col("lsn").alias("at"), F.when(F.col("lsn") % 11 == 0, 0).otherwise(F.col("lsn")).cast("long").alias("restart_lsn"), F.when(F.col("lsn") % 22 == 0, 0).otherwise(F.col("lsn")).cast("long").alias("confirmed_flush_lsn"), F.lit("s").alias("system_identifier"), F.lit(1).alias("timeline_id"))
    rows = control.slot_history(seen).crossJoin(F.broadcast(end))
    rows = rows.withColumns({"observable": F.lit(True), "durable_lsn": F.col("end_lsn"), "slot_exists": F.lit(True), "current_wal_lsn": F.col("end_lsn"), "destination_rows": F.lit(1)})
    return reconcile.slot_verdicts(rows).groupBy("slot", "verdict").agg(F.count("*").alias("seen"))


@query
def lag_steady(spark, sf):
    samples = change_log(spark, sf).select(F.col("user_id").alias("source"), F.col("lsn").alias("at"), F.col("value").alias("lag"))
    return control.steady(samples, 60)


@query
def commit_triggers(spark, sf):
    rows = [("a", False, 1, 10, 10, False), ("b", False, 1, 10, 6000, False), ("c", False, 300 << 20, 10, 6000, False), ("d", False, 1, 300_000, 6000, True), ("e", True, 300 << 20, 1, 1, True), ("f", False, 1, 1, 1, True), ("g", False, 300 << 20, 300_000, 1, False)]
    return control.commit_trigger(literal(spark, "name string, phase_changes boolean, bytes long, events long, age_ms long, drained boolean", rows)).select("name", "trigger")


@query
def resume_point(spark, sf):
    """Up to the first transaction that isn't whole: here one of the last hundred."""
    log = change_log(spark, sf)
    whole = assembly.completeness(log, txn_ends(log))
    top = log.agg(F.max("txn_id")).first()[0]
    return control.resume_point(whole.withColumn("complete", F.col("complete") | (F.col("txn_id") < top - 100)))


@query
def truncate_modes(spark, sf):
    log, cut = with_truncates(spark, sf)
    marks = log.where(cut).select("event_type", "lsn")
    logged = control.truncate_effect(marks, "log").withColumn("mode", F.lit("log"))
    return control.truncate_effect(marks, "replicate").withColumn("mode", F.lit("replicate")).unionByName(logged).unionByName(control.truncate_effect(marks, "ignore").withColumn("mode", F.lit("ignore")))


@query
def telling_columns(spark, sf):
    image = F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type"), F.lit("props"), F.when(F.col("lsn") % 2 == 0, schemas.UNAVAILABLE).otherwise(F.col("props")))
    left = control.telling(image, ["user_id"], schemas.UNAVAILABLE)
    return change_log(spark, sf).select("lsn", F.array_join(F.array_sort(F.map_keys(left)), ",").alias("columns"))


@query
def snapshot_notifications(spark, sf):
    rows = [(1, '{"observation": "STARTED"}'), (2, '{"observation": "TABLE_SCAN_COMPLETED", "scanned_collection": "app.a", "total_rows_scanned": "12", "status": "SUCCEEDED"}'), (3, '{"observation": "TABLE_SCAN_COMPLETED", "scanned_collection": "app.b", "total_rows_scanned": "0", "status": "EMPTY"}'), (4, '{"observation": "COMPLETED"}')]
    return control.notification(literal(spark, "seq long, value string", rows))


@query
def snapshot_phase(spark, sf):
    found = snapshot_notifications(spark, sf)
    out = None
    for name, tables, upto in (("whole", ["app.a", "app.b"], 4), ("one missing", ["app.a", "app.b", "app.c"], 4), ("running", ["app.a", "app.b"], 3), ("not begun", ["app.a"], 0)):
        one = control.snapshot_phase(found.where(F.col("seq") <= upto), literal(spark, "src_table string", [(t,) for t in tables])).withColumn("name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("name", "state")


@query
def snapshot_watermarks(spark, sf):
    """The fence of each table whose image is complete."""
    rows = change_log(spark, sf).groupBy(F.col("event_type").alias("src_table")).agg(F.max("lsn").alias("snapshot_lsn"))
    return rows.join(F.broadcast(literal(spark, "src_table string, snapshot_state string", STATES)), "src_table").where("snapshot_state = 'complete'").select("src_table", "snapshot_lsn")


@query
def wal_position(spark, sf):
    """One server a user: what a primary has written, what a standby has replayed."""
    seen = change_log(spark, sf).select(F.col("user_id").alias("server"), (F.col("user_id") % 4 == 0).alias("in_recovery"), F.col("lsn").alias("write_lsn"), F.when(F.col("lsn") % 2 == 0, F.col("lsn") - 1).alias("replay_lsn"))
    return catalog.wal_position(seen)


@query
def source_catalog(spark, sf):
    """Relations with their columns, key and publication; partitions under their root."""
    relations = literal(spark, "oid long, schema string, table string, root long", [(1, "app", "a", None), (2, "app", "p", None), (3, "app", "p_1", 2), (4, "app", "p_2", 2)])
    columns = literal(spark, "oid long, attnum int, name string, type string, is_key boolean", [(1, 2, "v", "text", False), (1, 1, "id", "bigint", True), (2, 1, "at", "date", True)])
    return catalog.relations(relations, columns, literal(spark, "oid long", [(1,), (2,)]))


@query
def partition_children(spark, sf):
    relations = literal(spark, "oid long, schema string, table string, root long", [(1, "app", "a", None), (2, "app", "p", None), (3, "app", "p_1", 2), (4, "app", "p_2", 2)])
    return catalog.partitions(relations).select("schema", "table", "root_schema", "root_table")


@query
def synthetic_changes(spark, sf):
    """A wave of changes over orders, the same for the same seed."""
    return generated(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 42)


@query
def inspection(spark, sf):
    """What a destination holds: per table its rows, operations, last position, and whether its image is complete."""
    log = change_log(spark, sf)
    return control.inspected(log.select(F.col("event_type").alias("src_table"), "op", "lsn"), literal(spark, "src_table string, snapshot_state string", STATES))


@query
def acknowledgement_guard(spark, sf):
    """Per slot: whether the source was told of more than is durable."""
    seen = change_log(spark, sf).groupBy(F.col("user_id").alias("slot")).agg(F.max("lsn").alias("top"))
    seen = seen.select("slot", F.when(F.col("slot") % 5 != 0, F.col("top")).alias("confirmed_flush_lsn"), F.when(F.col("slot") % 3 != 0, F.col("top") - (F.col("slot") % 2)).alias("durable_lsn"), (F.col("slot") % 2 == 0).alias("snapshot_reads_data"))
    return reconcile.acknowledgement(seen)


@query
def typed_offsets(spark, sf):
    """Offset maps that differ in types only aren't equal."""
    rows = change_log(spark, sf).select("lsn", F.format_string('{"lsn": %d, "ts": "%d", "last": true}', "lsn", "lsn").alias("a"), F.when(F.col("lsn") % 2 == 0, F.format_string('{"ts": "%d", "last": true, "lsn": %d}', "lsn", "lsn")).otherwise(F.format_string('{"lsn": "%d", "ts": "%d", "last": true}', "lsn", "lsn")).alias("b"))
    maps = rows.select("lsn", reconcile.typed_offsets(F.col("a")).alias("a"), reconcile.typed_offsets(F.col("b")).alias("b"))
    return maps.select("lsn", F.try_element_at("a", F.lit("lsn"))["kind"].alias("kind"), reconcile.offsets_equal("a", "b").alias("equal"))


@query
def normalized_types(spark, sf):
    names = ["TINYINT", "HUGEINT", "real", "FLOAT", "Boolean", "JSON", "TEXT", "TIMESTAMP", "DECIMAL(10,2)"]
    return literal(spark, "type_name string", [(n,) for n in names]).select("type_name", lattice.normalized(F.col("type_name")).alias("kind"))
