"""The keyed fold: what a group of changes leaves of each key, decided per physical row.

A key's state is an ordered list of entries: the row the destination held before (START), or rows of this group. Inserts
append; updates replace, and deletes remove, the entry they target. With several entries the before-image decides which;
where it can't, the fold refuses (`ambiguous`) rather than guess. A truncate clears every key of its table: operations carry
the number of truncates before them, so that none is copied to the keys. The whole state machine is one `aggregate` over the
key's ordered operations, inside the JVM. A group of one key is sequential by meaning and can't be salted; commit groups
bound its length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from . import ranges

ROW = "map<string,string>"
ENTRY = f"struct<start:boolean,row:{ROW}>"
STATE = f"struct<live:array<{ENTRY}>,epoch:bigint,cut_txn:string,dropped:array<struct<epoch:bigint,rows:int>>,ambiguous:string,txn:string>"


def last_writer(log: DataFrame, keys: list[str], order: str = "lsn") -> DataFrame:
    """The degenerate fold of keys that are never reused within a group: the last event of each key, unless it deletes.
    max_by combines before the shuffle, so a hot key sends one row per task."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("last"))
    return last.where(F.col("last.op") != S.DELETE).select(*keys, "last.*")


def cuts(log: DataFrame, target: str = "target") -> DataFrame:
    """The truncates (op t) of a log: target, seq, txn, and epoch, their number within their target from 0."""
    rows = log.where(F.col("op") == S.TRUNCATE).select(target, "seq", F.col("txn").cast("string").alias("txn"))
    return ranges.running_sum(rows, [target], "seq", F.lit(1), "epoch").withColumn("epoch", F.col("epoch") - 1)


def key_operations(log: DataFrame, target: str = "target", key: str = "key", parts: int | None = None) -> DataFrame:
    """Events as per-key operations: an update that changes the key removes the old key and places the new one. log has
    target, key, old_key, seq, txn, op, before, row (maps). A truncate (op t) reaches every key of its target, so operations
    carry their epoch (the truncates before them) and the transaction of the truncate that ends it (cut_txn), if any."""
    marked = ranges.running_sum(log, [target], "seq", (F.col("op") == S.TRUNCATE).cast("long"), "epoch", parts)
    ends = marked.where(F.col("op") == S.TRUNCATE).select(F.col(target).alias("__t"), (F.col("epoch") - 1).alias("__e"), F.col("txn").cast("string").alias("cut_txn"))
    moved = (F.col("op") == S.UPDATE) & F.col("old_key").isNotNull() & (F.col("old_key") != F.col(key))
    kind = F.when(F.col("op").isin(S.INSERT, S.SNAPSHOT_READ), "place").when(F.col("op") == S.UPDATE, "update").when(F.col("op") == S.DELETE, "remove")
    part = lambda k, what, n: F.struct(k.alias("key"), what.alias("kind"), (F.col("seq") * 2 + n).alias("seq"), F.col("txn").cast("string").alias("txn"), F.col("before"), F.col("row"))
    steps = F.when(moved, F.array(part(F.col("old_key"), F.lit("remove"), 0), part(F.col(key), F.lit("place"), 1))).otherwise(F.array(part(F.col(key), kind, 1)))
    rows = marked.where(F.col("op") != S.TRUNCATE).select(target, "epoch", F.explode(steps).alias("s")).select(target, "epoch", "s.*")
    rows = rows.join(ends, (F.col(target) == F.col("__t")) & (F.col("epoch") == F.col("__e")), "left")
    return rows.drop("__t", "__e")


def _concrete(live: Column) -> Column:
    return F.filter(live, lambda e: ~e["start"])


def _target(live: Column, telling: Column) -> Column:
    """The entry an update or delete means: its index, -1 for none, null if that can't be told."""
    def fits(e: Column) -> Column:
        known = F.filter(telling, lambda kv: ~e["start"] | F.map_contains_key(e["row"], kv["key"]))
        equal = F.forall(known, lambda kv: F.try_element_at(e["row"], kv["key"]).eqNullSafe(kv["value"]))
        return equal & (F.size(known) > 0)

    places = F.filter(F.transform(live, lambda e, i: F.when(fits(e), F.struct(e["start"].alias("start"), i.alias("i")))), lambda p: p.isNotNull())
    starts = F.filter(places, lambda p: p["start"])
    several = F.when(F.size(telling) == 0, F.when(F.size(_concrete(live)) <= 1, F.lit(-1))).when(F.size(starts) > 0, starts[0]["i"]).when(F.size(places) > 0, places[0]["i"])
    return F.when(F.size(live) == 0, F.lit(-1)).when(F.size(live) == 1, F.lit(0)).otherwise(several)


def _cleared(a: Column) -> Column:
    """The state once the truncate that ends its epoch has run: it is recorded how many of this group's rows went."""
    gone = F.struct(a["epoch"].alias("epoch"), F.size(_concrete(a["live"])).alias("rows"))
    return F.concat(a["dropped"], F.array(gone))


def _torn(a: Column, txn: Column) -> Column:
    """A transaction that ends with two rows under one key never was: the stream was misread."""
    return F.coalesce(a["txn"] != txn, a["txn"].isNotNull()) & (F.size(_concrete(a["live"])) > 1)


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _step(keys: list[str]):
    none = F.array().cast(f"array<{ENTRY}>")
    blank = F.array().cast("array<struct<key:string,value:string>>")

    def after(held: Column, at: Column, op: Column) -> Column:
        """The entries once the operation is done to the entry at `at`."""
        row = F.struct(F.lit(False).alias("start"), op["row"].alias("row")).cast(ENTRY)
        replaced = F.transform(held, lambda e, i: F.when(i == at, row).otherwise(e))
        removed = F.filter(held, lambda e, i: i != at)
        return (
            F.when(op["kind"] == "place", F.concat(held, F.array(row)))
            .when(op["kind"] == "update", F.when(at >= 0, replaced).otherwise(F.array(row))).otherwise(F.when(at >= 0, removed).otherwise(none))
        )

    def step(a: Column, op: Column) -> Column:
        cut = op["epoch"] > a["epoch"]
        torn = _torn(a, F.when(cut, a["cut_txn"]).otherwise(op["txn"]))
        telling = F.filter(F.coalesce(F.map_entries(op["before"]), blank), lambda kv: ~kv["key"].isin(keys) & ~kv["value"].eqNullSafe(F.lit(S.UNAVAILABLE)))
        aims = op["kind"].isin("update", "remove")

        def state(held: Column, at: Column) -> Column:
            lost = F.when(a["ambiguous"].isNotNull(), a["ambiguous"]).when(torn, "two rows at a transaction's end").when(aims & at.isNull(), "no single row matches")
            return F.struct(
                after(held, at, op).alias("live"), op["epoch"].alias("epoch"), op["cut_txn"].alias("cut_txn"), F.when(cut, _cleared(a)).otherwise(a["dropped"]).alias("dropped"), lost.alias("ambiguous"), op["txn"].alias("txn")
            ).cast(STATE)

        return _let(F.when(cut, none).otherwise(a["live"]), lambda held: _let(_let(telling, lambda told: _target(held, told)), lambda at: state(held, at)))

    return step


def physical_fold(operations: DataFrame, destination: DataFrame, keys: list[str], target: str = "target") -> DataFrame:
    """target, key, action (upsert, delete or keep), row, ambiguous, and dropped: for each truncate that met rows of this
    group, its number within the target and how many. destination: target, key, row (a map) of the rows that exist; operations
    as key_operations() makes them."""
    ops = operations.groupBy(target, "key").agg(F.collect_list(F.struct("seq", "txn", "kind", "before", "row", "epoch", "cut_txn")).alias("ops"))
    ops = ops.withColumn("ops", F.array_sort("ops", lambda x, y: F.when(x["seq"] < y["seq"], -1).when(x["seq"] > y["seq"], 1).otherwise(0)))
    rows = ops.join(destination.select(target, "key", F.col("row").alias("held")), [target, "key"], "left")
    none = F.array().cast(f"array<{ENTRY}>")
    start = F.when(F.col("held").isNotNull() & (F.col("ops")[0]["epoch"] == 0), F.array(F.struct(F.lit(True).alias("start"), F.col("held").alias("row")).cast(ENTRY))).otherwise(none)
    nothing = F.lit(None).cast("string")
    seed = F.struct(start.alias("live"), F.col("ops")[0]["epoch"].alias("epoch"), nothing.alias("cut_txn"), F.array().cast("array<struct<epoch:bigint,rows:int>>").alias("dropped"), nothing.alias("ambiguous"), nothing.alias("txn")).cast(STATE)
    rows = rows.withColumn("end", F.aggregate("ops", seed, _step(keys)))
    end, cut = F.col("end"), F.col("end.cut_txn").isNotNull()
    torn = F.when(cut, _torn(end, F.col("end.cut_txn"))).otherwise(F.size(_concrete(F.col("end.live"))) > 1)
    ambiguous = F.coalesce(F.col("end.ambiguous"), F.when(torn, F.lit("two rows at a transaction's end")))
    live = F.when(cut, none).otherwise(F.col("end.live"))
    left = _concrete(live)
    action = F.when(F.size(left) > 0, "upsert").when(F.size(live) > 0, "keep").otherwise("delete")
    dropped = F.when(cut, _cleared(end)).otherwise(F.col("end.dropped"))
    return rows.select(target, "key", action.alias("action"), F.try_element_at(left, F.lit(-1))["row"].alias("row"), F.filter(dropped, lambda d: d["rows"] > 0).alias("dropped"), ambiguous.alias("ambiguous"))


def rows_removed(folded: DataFrame, truncates: DataFrame, held: DataFrame, target: str = "target") -> DataFrame:
    """truncates (cuts()) with rows_removed: the rows of this group that were live, and for the first of a target the rows that the
    destination held, too. held: target, rows."""
    per = folded.select(target, F.explode("dropped").alias("d")).groupBy(target, F.col("d.epoch").alias("epoch")).agg(F.sum("d.rows").alias("__own"))
    out = truncates.join(per, [target, "epoch"], "left").join(held.select(target, F.col("rows").alias("__held")), target, "left")
    removed = F.coalesce("__own", F.lit(0)) + F.when(F.col("epoch") == 0, F.coalesce("__held", F.lit(0))).otherwise(0)
    return out.withColumn("rows_removed", removed.cast("long")).drop("__own", "__held")


def truncate_epochs(log: DataFrame, is_truncate: Column, order: str, by: list[str], parts: int | None = None) -> DataFrame:
    """Every event with the number of truncates of its table up to it, and whether it outlives the last one."""
    rows = log.withColumn("is_truncate", is_truncate)
    rows = ranges.running_sum(rows, by, order, F.col("is_truncate").cast("long"), "epoch", parts)
    last = rows.where("is_truncate").groupBy(*[F.col(c).alias(f"__last_{c}") for c in by]).agg(F.count("*").alias("__last"))
    met = [F.col(c).eqNullSafe(F.col(f"__last_{c}")) for c in by]
    rows = rows.join(last, reduce(lambda a, b: a & b, met), "left")
    survives = ~F.col("is_truncate") & (F.col("epoch") == F.coalesce("__last", F.lit(0)))
    return rows.withColumn("survives", survives).drop("__last", *(f"__last_{c}" for c in by))


def null_safe(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def delete_keys(rows: DataFrame, keys_to_delete: DataFrame, keys: list[str]) -> DataFrame:
    """rows without those whose key, nulls included, is to be deleted."""
    return rows.alias("l").join(keys_to_delete.alias("r"), null_safe(keys, "l", "r"), "left_anti")


def merge(rows: DataFrame, changed: DataFrame, removed: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the touched keys, then insert their final rows; columns that one side lacks become null."""
    touched = changed.select(*keys).unionByName(removed.select(*keys)).distinct()
    return delete_keys(rows, touched, keys).unionByName(changed, allowMissingColumns=True)


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Identities that occur more than once: a commit that has any is refused."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
