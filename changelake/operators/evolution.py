"""Schema evolution: column differences by position number, ordered application, renames that arrive late, backfills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lattice


def column_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Differences of two column lists (attnum, name, type), matched by attnum, which survives a rename."""
    rows = before.alias("o").join(after.alias("n"), F.col("o.attnum") == F.col("n.attnum"), "full_outer")
    renamed, retyped = F.col("o.name") != F.col("n.name"), F.col("o.type") != F.col("n.type")
    kind = F.when(F.col("o.attnum").isNull(), "added").when(F.col("n.attnum").isNull(), "dropped").when(renamed, "renamed").when(retyped, "type_changed")
    rows = rows.select(
        F.coalesce("o.attnum", "n.attnum").alias("attnum"), kind.alias("kind"), F.col("o.name").alias("old_name"), F.col("n.name").alias("new_name"),
        F.coalesce(renamed & retyped, F.lit(False)).alias("also_retyped"),
    )
    return rows.where("kind IS NOT NULL")


def application_order(diff: DataFrame) -> DataFrame:
    """The order in which differences apply: drops whose name a rename takes over, renames, other drops, then the rest."""
    taken = diff.where("kind = 'renamed'").select(F.col("new_name").alias("old_name")).distinct().withColumn("reused", F.lit(True))
    rows = diff.join(F.broadcast(taken), "old_name", "left")  # a table's columns
    step = F.when((F.col("kind") == "dropped") & F.col("reused"), 1).when(F.col("kind") == "renamed", 2).when(F.col("kind") == "dropped", 3).otherwise(4)
    return rows.select("attnum", "kind", "old_name", "new_name", step.alias("step"))


def ensured(rows: DataFrame, columns: dict[str, str], strict: bool = False) -> DataFrame:
    """rows with at least these columns of the five types: missing ones are null, narrower ones are widened; with strict a
    needed widening is an error."""
    have = dict(rows.dtypes)
    out = rows
    names = {"bigint": "BIGINT", "int": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR"}
    for name, kind in columns.items():
        if name not in have:
            out = out.withColumn(name, F.lit(None).cast(lattice.SPARK_TYPES[kind]))
            continue
        old = names.get(have[name])
        if old is None:
            raise TypeError(f"column {name} has the type {have[name]}, which is never altered")
        wide = old if old == kind or kind == "VARCHAR" and old == "VARCHAR" else "DOUBLE" if {old, kind} == {"BIGINT", "DOUBLE"} else "VARCHAR"
        if wide != old:
            if strict:
                raise TypeError(f"column {name} would have to widen from {old} to {wide}")
            out = out.withColumn(name, F.col(name).cast(lattice.SPARK_TYPES[wide]))
    return out


def backfilled(rows: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """rows with new columns filled from the source's current values, by key."""
    current = source.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    out = rows.join(current, keys, "left")
    for c in columns:
        have = F.col(c) if c in rows.columns else F.lit(None)
        out = out.withColumn(c, F.coalesce(F.col(f"__{c}"), have)).drop(f"__{c}")
    return out


def uniform_constants(source: DataFrame, columns: list[str], defaults: dict[str, str] | None = None) -> DataFrame:
    """For a table without a key: whether each new column has one value throughout the source, which may then be given to all rows
    (backfill), or not (refuse). An empty source gives the declared default, if there is one."""
    defaults = defaults or {}
    found = source.agg(F.count("*").alias("rows"), *[f(F.col(c)).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max), ("some", F.count))])
    one = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.when(F.col("rows") == 0, F.lit(defaults.get(c))).when((F.col(f"some_{i}") == 0) | (F.col(f"lo_{i}") == F.col(f"hi_{i}")) & (F.col(f"some_{i}") == F.col("rows")), F.col(f"lo_{i}").cast("string")).alias("value"),
            F.when(F.when(F.col("rows") == 0, F.lit(c in defaults)).otherwise((F.col(f"some_{i}") == 0) | (F.col(f"lo_{i}") == F.col(f"hi_{i}")) & (F.col(f"some_{i}") == F.col("rows"))), "backfill").otherwise("refuse").alias("decision"),
        )
        for i, c in enumerate(columns)
    ]
    return found.select("rows", F.explode(F.array(*one)).alias("x")).select("x.*", "rows")


def renamed(rows: DataFrame, old: str, new: str, presence: DataFrame, event_id: str) -> DataFrame:
    """A rename that meets rows already written under the new name: those whose event carried the new field keep its value,
    null included; all others take the old column's. presence: event_id of events that carried the new field."""
    if new not in rows.columns:
        return rows.withColumnRenamed(old, new)
    carried = presence.select(F.col(event_id).alias("__id")).distinct().withColumn("__new", F.lit(True))
    out = rows.join(carried, F.col(event_id) == F.col("__id"), "left")
    return out.withColumn(new, F.when(F.col("__new"), F.col(new)).otherwise(F.col(old))).drop("__id", "__new", old)


def presence(events: DataFrame, target: Column, event_id: str, image: str) -> DataFrame:
    """Which fields each event's image carried: one row per target, event and field; an explicit null is present."""
    return events.select(target.alias("target"), event_id, F.explode(F.json_object_keys(image)).alias("column_name")).distinct()


def backfill_missing(found: DataFrame, known: list[str]) -> DataFrame:
    """Fields that no catalog observation explains."""
    return found.where(~F.col("column_name").isin(known)).select("target", "column_name").distinct()
