"""Change logs: envelopes decoded from JSON, and a deterministic log made from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S

TXN_EVENTS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table events as a change log of the table app.users: transactions of TXN_EVENTS events, the last one open."""
    op = F.when(F.col("event_type") == "error", S.DELETE).when(F.col("event_type") == "signup", S.INSERT).otherwise(S.UPDATE)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("lsn"),
        F.expr(f"event_id div {TXN_EVENTS}").alias("txn_id"),
        (F.col("event_id") % TXN_EVENTS + 1).alias("total_order"),
        "user_id", op.alias("op"), "event_type", "value", "ts", "props",
    )


def txn_ends(log: DataFrame) -> DataFrame:
    """END records: what the source declares of each transaction. Some declare wrongly, for the proof to refuse them: an
    event too many where txn_id % 50 = 13, a table's count too high where it is 21."""
    per = log.groupBy("txn_id", "event_type").agg(F.count("*").alias("n"))
    first = F.min("event_type").over(Window.partitionBy("txn_id"))
    per = per.withColumn("n", F.col("n") + F.when((F.col("txn_id") % 50 == 21) & (F.col("event_type") == first), 1).otherwise(0))
    ends = per.groupBy("txn_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("data_collections"))
    return ends.select("txn_id", (F.lit(TXN_EVENTS) + F.when(F.col("txn_id") % 50 == 13, 1).otherwise(0)).cast("long").alias("event_count"), "data_collections")


def end_records(log: DataFrame) -> DataFrame:
    """The END records that a log holds: of transactions whose last event is there. Their position is their last event's."""
    return log.where(F.col("total_order") == TXN_EVENTS).select("txn_id", "lsn")


def generated(rows: DataFrame, key: str, seed: int, scale: int = 1) -> DataFrame:
    """A wave of changes of a table's rows: some updates and deletes, and inserts of new keys; the same for the same seed. seq orders it."""
    draw = lambda salt: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}{salt}"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long") % 100
    op = F.when(draw("c") < 5 * scale, S.DELETE).when(draw("c") < 20 * scale, S.UPDATE)
    old = rows.withColumn("op", op).where("op IS NOT NULL")
    new = rows.where(draw("i") < 3 * scale).withColumn(key, -F.col(key) - 1).withColumn("op", F.lit(S.INSERT))
    return old.unionByName(new).withColumn("seq", F.abs(F.col(key)) * 3 + F.when(F.col("op") == S.INSERT, 2).otherwise(0))


def as_stream(log: DataFrame, columns: list[str]) -> DataFrame:
    """A log of app.users as records of a serial stream: events and, after each transaction's last one, its END."""
    image = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])
    txn, none = F.col("txn_id").cast("string"), F.lit(None).cast("map<string,string>")
    events = log.select(
        (F.col("lsn") * 4).alias("seq"), F.lit("data").alias("kind"), F.lit("app.users").alias("src_table"), "op", "lsn", txn.alias("txn_id"), F.col("total_order").cast("long").alias("total_order"), F.unix_millis(F.col("ts").cast("timestamp")).alias("source_ts_ms"),
        F.when(F.col("op") == S.DELETE, image).otherwise(none).alias("before"), F.when(F.col("op") != S.DELETE, image).otherwise(none).alias("row"), F.lit(None).cast("long").alias("event_count"), F.lit(None).cast("map<string,bigint>").alias("data_collections"),
    )
    ends = log.where(F.col("total_order") == TXN_EVENTS).select(
        (F.col("lsn") * 4 + 1).alias("seq"), F.lit("txn_end").alias("kind"), F.lit(None).cast("string").alias("src_table"), F.lit(None).cast("string").alias("op"), "lsn", txn.alias("txn_id"), F.lit(None).cast("long").alias("total_order"), F.lit(None).cast("long").alias("source_ts_ms"),
        none.alias("before"), none.alias("row"), F.lit(TXN_EVENTS).cast("long").alias("event_count"), F.create_map(F.lit("app.users"), F.lit(TXN_EVENTS).cast("long")).alias("data_collections"),
    )
    return events.unionByName(ends)


def kind_of(topic: Column, prefix: str, e: Column) -> Column:
    """What a record is, by its topic, operation and snapshot marker."""
    marker = F.lower(F.coalesce(e["source"]["snapshot"], F.lit("false")))
    return (
        F.when(topic == f"{prefix}.transaction", F.when(e["status"] == "BEGIN", "txn_begin").when(e["status"] == "END", "txn_end").otherwise("unknown"))
        .when(topic == f"__debezium-heartbeat.{prefix}", "heartbeat")
        .when(e["op"] == S.MESSAGE, "logical_message").when(e["op"] == S.TRUNCATE, "truncate")
        .when((e["op"] == S.SNAPSHOT_READ) | (marker != "false") & e["op"].isNotNull(), "snapshot")
        .when(e["op"].isin(S.INSERT, S.UPDATE, S.DELETE), "data").otherwise("unknown")
    )


def decode(raw: DataFrame, prefix: str) -> DataFrame:
    """Envelopes (topic, key, value as JSON) as change events. Malformed JSON fails the query rather than being guessed at."""
    e = F.from_json("value", S.ENVELOPE, {"mode": "FAILFAST"})
    rows = raw.withColumn("e", e)
    e = F.col("e")
    txn = F.coalesce(e["source"]["txId"].cast("string"), F.split(F.coalesce(e["transaction"]["id"], e["id"]), ":")[0])
    declared = F.map_from_entries(F.transform(e["data_collections"], lambda d: F.struct(d["data_collection"], d["event_count"])))
    return rows.select(
        "topic", kind_of(F.col("topic"), prefix, e).alias("kind"), e["op"].alias("op"), e["source"]["schema"].alias("src_schema"),
        e["source"]["table"].alias("src_table"), e["source"]["lsn"].alias("lsn"), txn.alias("txn_id"),
        e["transaction"]["total_order"].alias("total_order"), e["transaction"]["data_collection_order"].alias("dc_order"),
        e["source"]["ts_ms"].alias("source_ts_ms"), e["source"]["snapshot"].alias("snapshot"), F.col("key").alias("key_json"),
        e["before"].alias("before_json"), e["after"].alias("after_json"), e["status"].alias("txn_status"), e["event_count"].alias("txn_event_count"),
        declared.alias("data_collections"), F.octet_length("value").alias("nbytes"),
    )


def envelopes(log: DataFrame, prefix: str = "app") -> DataFrame:
    """A change log as JSON envelopes, one record per event: topic, key, value."""
    image = F.to_json(F.struct("user_id", "value"))
    value = F.struct(
        F.col("op"), F.when(F.col("op") == "d", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"),
        F.struct(F.lit("public").alias("schema"), F.lit("users").alias("table"), F.col("lsn"), F.col("txn_id").alias("txId"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), F.lit("false").alias("snapshot")).alias("source"),
        F.struct(F.concat_ws(":", F.col("txn_id").cast("string"), F.col("lsn").cast("string")).alias("id"), F.col("total_order")).alias("transaction"),
    )
    return log.select(F.lit(f"{prefix}.public.users").alias("topic"), F.to_json(F.struct("user_id")).alias("key"), F.to_json(value).alias("value"))
