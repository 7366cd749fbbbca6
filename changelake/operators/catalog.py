"""The source catalog: what changed between observations, when a change counts, and when it may be applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DESTRUCTIVE = ("dropped", "recreated")


def same_lifecycle(a: str, b: str) -> Column:
    """One relation's life: the same oid and row type. A TRUNCATE gives a new file, which doesn't matter."""
    return F.col(f"{a}.oid").eqNullSafe(F.col(f"{b}.oid")) & F.col(f"{a}.reltype_oid").eqNullSafe(F.col(f"{b}.reltype_oid"))


def compare(known: DataFrame, observed: DataFrame, liveness: DataFrame) -> DataFrame:
    """Changes between the known and the observed relations (schema, table, oid, reltype_oid, published, columns).

    A relation's absence counts only where its schema shows any relation at all (liveness: schema, visible)."""
    k, o = known.alias("k"), observed.alias("o")
    rows = k.join(o, (F.col("k.schema") == F.col("o.schema")) & (F.col("k.table") == F.col("o.table")), "full_outer")
    kind = (
        F.when(F.col("k.oid").isNull(), "new").when(F.col("o.oid").isNull(), "dropped").when(~same_lifecycle("k", "o"), "recreated")
        .when(F.col("k.published") & ~F.col("o.published"), "unpublished").when(~F.col("k.published") & F.col("o.published"), "republished")
        .when(~F.col("k.columns").eqNullSafe(F.col("o.columns")), "schema")
    )
    seen = liveness.where("visible").select(F.col("schema").alias("live_schema"))
    rows = rows.select(F.coalesce("k.schema", "o.schema").alias("schema"), F.coalesce("k.table", "o.table").alias("table"), kind.alias("kind"), F.col("k.oid").alias("old_oid"), F.col("o.oid").alias("new_oid")).where("kind IS NOT NULL")
    return rows.join(F.broadcast(seen), F.col("schema") == F.col("live_schema"), "left_semi")  # one row per schema of a catalog


def schema_liveness(schemas: DataFrame, relations: DataFrame) -> DataFrame:
    """Relations per watched schema, with the empty ones, and whether absence there means anything."""
    counted = schemas.join(relations.select(F.col("schema"), F.lit(1).alias("one")), "schema", "left").groupBy("schema").agg(F.count("one").alias("relations"))
    return counted.withColumn("visible", F.col("relations") > 0)


def confirmed(polls: DataFrame, needed: int = 2) -> DataFrame:
    """Shapes that `needed` consecutive polls of a relation agreed on: relation, shape, first and confirming poll. A poll
    with another shape, or none, starts the streak anew. polls: relation, poll, shape."""
    own = Window.partitionBy("relation").orderBy("poll")
    fresh = ~F.col("shape").eqNullSafe(F.lag("shape").over(own)) | (F.col("poll") != F.coalesce(F.lag("poll").over(own), F.lit(-2)) + 1)
    rows = polls.withColumn("streak", F.sum(fresh.cast("int")).over(own))
    runs = rows.where("shape IS NOT NULL").groupBy("relation", "streak", "shape").agg(F.min("poll").alias("first_poll"), F.count("*").alias("polls"))
    return runs.where(F.col("polls") >= needed).select("relation", "shape", "first_poll", (F.col("first_poll") + needed - 1).alias("confirmed_at"), "polls")


def due(changes: DataFrame, durable_lsn: int, grace_lsn: int | None = None) -> DataFrame:
    """Changes that may apply: everything before their detection is durable. With grace, also those that the durable position
    is at most so many bytes short of, which an idle source would never make due."""
    return changes.where(F.col("detected_lsn") <= durable_lsn + (grace_lsn or 0))


def plan(changes: DataFrame, durable_lsn: int, owed: DataFrame, drop_mode: str = "log", most: int = 1, allow: bool = False) -> DataFrame:
    """Due changes with their decision. A drop of a table whose image is owed is deferred: the new image's own evidence decides.
    Drops that would destroy data are refused, all of them, where there are more than `most`; new tables are always let in."""
    rows = due(changes, durable_lsn).join(owed.select("table", F.lit(True).alias("__owed")), "table", "left")
    held_back = (F.col("kind") == "dropped") & F.col("__owed").isNotNull()
    destroys = (F.col("kind") == "dropped") & ~held_back & F.lit(drop_mode == "replicate")
    total = rows.agg(F.count_if(destroys).alias("__total"))  # one row
    decision = F.when(held_back, "deferred").when(destroys & (F.col("__total") > most) & F.lit(not allow), "refused").otherwise("apply")
    return rows.join(F.broadcast(total), F.lit(True)).withColumn("decision", decision).drop("__owed", "__total")


def admissions(observed: DataFrame, ownership: str) -> DataFrame:
    """Newly seen relations (table, is_partition, published, all_tables, error) with their admission: partitions come with their root;
    what is published already is someone else's doing; what isn't is added, unless the publication belongs to others."""
    rows = observed.where(~F.col("is_partition"))
    state = F.when(F.col("published") | F.col("all_tables"), "external").when(F.lit(ownership == "external"), "refused").when(F.col("error").isNotNull(), "error").otherwise("admitted")
    return rows.select("table", state.alias("admission"))


def captured(log: DataFrame, tables: list[str] | None, column: str) -> DataFrame:
    """Events of the configured tables; of all tables where none are configured (discovery)."""
    return log if tables is None else log.where(F.col(column).isin(*tables))


def relations(tables: DataFrame, columns: DataFrame, published: DataFrame) -> DataFrame:
    """Root relations with their columns in order, key, publication and number of partitions. tables: oid, schema, table, root."""
    ordered = F.array_sort(F.collect_list(F.struct("attnum", "name", "type")))
    keys = F.transform(F.array_sort(F.collect_list(F.when(F.col("is_key"), F.struct("attnum", "name")))), lambda k: k["name"])
    lists = columns.groupBy("oid").agg(F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", c["name"], c["type"])), ",").alias("columns"), F.array_join(keys, ",").alias("key"))
    rows = tables.where("root IS NULL").join(lists, "oid", "left").join(published.select("oid").distinct().withColumn("published", F.lit(True)), "oid", "left")
    children = partitions(tables).groupBy(F.col("root").alias("oid")).agg(F.count("*").alias("partitions"))
    rows = rows.join(children, "oid", "left")
    return rows.select("schema", "table", "columns", "key", F.coalesce("published", F.lit(False)).alias("published"), F.coalesce("partitions", F.lit(0)).cast("long").alias("partitions"))


def partitions(tables: DataFrame) -> DataFrame:
    """Partitions with the relation that they belong to: their events are published under the root's name."""
    roots = tables.select(F.col("oid").alias("root"), F.col("schema").alias("root_schema"), F.col("table").alias("root_table"))
    return tables.where("root IS NOT NULL").join(roots, "root")


def identities(constraints: DataFrame, columns: DataFrame) -> DataFrame:
    """The key columns of each table, in the key's order: constraints (table, position, column_id) with columns (table, column_id, name)."""
    rows = constraints.join(columns, ["table", "column_id"])
    ordered = F.array_sort(F.collect_list(F.struct("position", "name")))
    return rows.groupBy("table").agg(F.array_join(F.transform(ordered, lambda c: c["name"]), ",").alias("key_columns"))


def wal_position(observed: DataFrame) -> DataFrame:
    """The source's position by server: what a primary has written, what a standby has replayed."""
    return observed.groupBy("server").agg(F.max(F.when(F.col("in_recovery"), F.col("replay_lsn")).otherwise(F.col("write_lsn"))).alias("current_lsn"))


def circuit_breaker(due_changes: DataFrame, most: int = 1, allow: bool = False) -> DataFrame:
    """Each due change with its decision: if one plan holds more than `most` destructive changes, all of them are refused."""
    destructive = F.col("kind").isin(*DESTRUCTIVE)
    total = F.sum(destructive.cast("long")).over(Window.partitionBy("plan_id"))
    decision = F.when(destructive & (total > most) & F.lit(not allow), "refused").otherwise("apply")
    return due_changes.withColumn("decision", decision)


def unrelatable(protected: DataFrame, known: DataFrame, counts: DataFrame) -> DataFrame:
    """Destination tables that hold rows but whose source relation was never recorded."""
    return protected.join(known.select("relation"), "relation", "left_anti").join(counts.where("rows > 0"), "relation")


def column_lists(columns: DataFrame) -> DataFrame:
    """Per relation its columns in order, as one text."""
    ordered = F.array_sort(F.collect_list(F.struct("attnum", "name", "type")))
    text = F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", c["attnum"].cast("string"), c["name"], c["type"])), ",")
    return columns.groupBy("schema", "table").agg(text.alias("columns"), F.count("*").alias("n_columns"))
