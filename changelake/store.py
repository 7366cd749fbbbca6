"""The destination: versioned Parquet tables whose commit is one file.

A commit writes files under names of its own and then one manifest, named by its commit id and created exclusively. The
manifest lists every table's files, columns and keys, open shadows, the state of each table's image, the resume point, the
group's audit row and the micro-batch it holds; so data, schema, audit and resume point become visible together or not at all.
Readers resolve the latest manifest. A lost race for a commit id is a conflict: someone else writes here. Nothing is
acknowledged before the manifest exists.

Keyed tables are buckets by a hash of the key, whose number follows their size, and up to MOST_DELTAS files of later changes:
a commit that touches a small part of a table writes its changes only, and readers put the last one of each key in place of
the bucket's row. Larger commits, and every so many small ones, rewrite the buckets that hold touched keys. Columns have
physical names of their own, so that to rename or drop one is a commit without data.

Files go through Hadoop's file system, so the root may be any path that Spark writes to; its create without overwrite is
atomic on HDFS and local file systems.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .machines import MACHINES
from .operators import fold

LEASE_SECONDS, WATCHDOG_SECONDS = 60, 300
BUCKET, DELETED, COMMIT = "__bucket", "__deleted", "__commit"
#: Buckets hold about so many rows; a table is cut anew, into twice as many, when they hold twice that on average.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 2_000_000, 8, 65_536
#: Changes stay beside the buckets until they are this part of a table, or so many files.
DELTA_SHARE, MOST_DELTAS = 0.1, 8
#: The manifest's layout; older ones are brought up to it when they are read.
LAYOUT = 2
EMPTY = {"layout": LAYOUT, "commit_id": 0, "tables": {}, "shadows": {}, "states": {}, "resume": None, "batches": -1, "owner": None, "epoch": 0}


class Conflict(RuntimeError):
    """Another writer committed first, or holds the lease."""


class IdentityViolation(RuntimeError):
    """A keyed table would hold an identity twice."""


class AmbiguousDelete(RuntimeError):
    """The fold can't tell which row a change means; the group is refused."""


class SchemaRefusal(RuntimeError):
    """A change of shape that would lose data or break an identity."""


def scratch(spark: SparkSession, label: str) -> str:
    """A folder of its own below the one that driver and executors share (spark.checkpoint.dir); a temporary one only where that is
    unset and everything runs on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='changelake-')}"
        atexit.register(shutil.rmtree, shared.removeprefix("file://"), ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def migrated(manifest: dict) -> dict:
    """A manifest in today's layout: what older ones lack gets its default, and nothing that they hold is lost."""
    if manifest.get("layout", 1) > LAYOUT:
        raise RuntimeError(f"layout {manifest['layout']} is newer than this program's")
    out = EMPTY | manifest | {"layout": LAYOUT}
    if not set(manifest) <= set(out):
        raise RuntimeError("a manifest's field would be lost")
    for entry in [*out["tables"].values(), *(s["entry"] for s in out["shadows"].values() if s["entry"])]:
        if isinstance(entry.get("versions"), dict):
            entry.setdefault("buckets", 8)
        entry.setdefault("deltas", [])
        entry.setdefault("rows", 0)
        entry.setdefault("physical", {c: c for c in entry["columns"]})
    return out


class Store:
    def __init__(self, spark: SparkSession, root: str, pipeline: str = "default", fault: Callable[[str], None] | None = None, buckets: int | None = None, bucket_rows: int = BUCKET_ROWS):
        """buckets: of new keyed tables; by default as many as their size asks for."""
        self.buckets, self.bucket_rows = buckets, bucket_rows
        self.spark, self.root, self.pipeline = spark, root.rstrip("/"), pipeline
        self.owner, self.term, self.stage = None, 0, "idle"
        self._fault = fault or (lambda anchor: None)
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.root}/{p}")
        self._fs = self._path("x").getFileSystem(spark._jsc.hadoopConfiguration())

    def fault(self, anchor: str) -> None:
        """A point at which a run may be made to fail."""
        self.stage = anchor
        self._fault(anchor)

    # Files

    def _names(self, folder: str, suffix: str = ".json") -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(folder))) if n.endswith(suffix))

    def _read(self, path: str):
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _create(self, path: str, content) -> bool:
        """Whether this call created the file; a file that exists stays as it is."""
        try:
            out = self._fs.create(self._path(path), False)
        except Exception as e:
            if self._fs.exists(self._path(path)):
                return False
            raise e
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
            out.hflush()
        finally:
            out.close()
        return True

    def probe(self) -> bool:
        """Whether this file system refuses to create a file twice, on which every commit relies."""
        path = f"_probe/{uuid.uuid4().hex}.json"
        return self._create(path, {}) and not self._create(path, {}) and self._fs.delete(self._path(path), False)

    # Manifests

    def _manifests(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("_manifest") if n[:-5].isdigit()]

    def manifest(self, commit_id: int) -> dict:
        return migrated(self._read(f"_manifest/{commit_id:020d}.json"))

    def latest(self) -> dict:
        """The state that readers see."""
        ids = self._manifests()
        return self.manifest(ids[-1]) if ids else json.loads(json.dumps(EMPTY))

    def log(self) -> list[dict]:
        """The audit rows of all commits."""
        old = [row for n in self._names("_audit") for row in self._read(f"_audit/{n}")]
        done = max((row["commit_id"] for row in old), default=0)
        return old + [self._read(f"_manifest/{i:020d}.json")["audit"] for i in self._manifests() if i > done]

    def describe(self, name: str) -> dict | None:
        """A table's columns with their types, its identity and its rows."""
        entry = self.latest()["tables"].get(name)
        return entry and {k: entry[k] for k in ("columns", "types", "keys", "rows")}

    # Reading

    def table(self, name: str) -> DataFrame | None:
        entry = self.latest()["tables"].get(name)
        return self._load(entry) if entry else None

    def shadow(self, name: str) -> DataFrame | None:
        held = self.latest()["shadows"].get(name)
        return self._load(held["entry"]) if held and held["entry"] else None

    def _empty(self, entry: dict) -> DataFrame:
        return self.spark.createDataFrame([], ", ".join(f"`{c}` {entry['types'][c]}" for c in entry["columns"]))

    def _files(self, entry: dict, paths: list[str], more: tuple[str, ...] = ()) -> DataFrame:
        """Files under their logical names; columns that came later are null in older files."""
        fields = [f"`{entry['physical'][c]}` {entry['types'][c]}" for c in entry["columns"]]
        fields += [f"`{c}` {'boolean' if c == DELETED else 'bigint'}" for c in more]
        rows = self.spark.read.schema(", ".join(fields)).parquet(*[f"{self.root}/{p}" for p in paths])
        return rows.select(*[F.col(f"`{entry['physical'][c]}`").alias(c) for c in entry["columns"]], *more)

    def _load(self, entry: dict, buckets: list[int] | None = None) -> DataFrame:
        """A table, or some of its buckets, with the changes that lie beside them."""
        parts = entry["versions"]
        if isinstance(parts, dict):
            parts = [v for k, v in sorted(parts.items()) if buckets is None or int(k) in buckets]
        rows = self._files(entry, parts) if parts else self._empty(entry)
        if not entry["deltas"]:
            return rows
        keys = entry["keys"]
        changes = self._files(entry, entry["deltas"], (DELETED, COMMIT))
        if buckets is not None:
            changes = changes.where(self._bucket(keys, entry["buckets"]).isin(buckets))
        rest = [c for c in changes.columns if c not in keys]
        last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), COMMIT).alias("l")).select(*keys, "l.*")
        kept = fold.delete_keys(rows, last.select(*keys), keys)
        return kept.unionByName(last.where(~F.col(DELETED)).select(*entry["columns"]))

    @staticmethod
    def _bucket(keys: list[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    # Lease

    def _held(self) -> tuple[int, dict]:
        terms = self._names("_lease")
        return (int(terms[-1][:-5]), self._read(f"_lease/{terms[-1]}")) if terms else (0, {"owner": "", "until": 0})

    def acquire(self, owner: str, now: float | None = None) -> int:
        """Takes or renews the single writer's lease; its term numbers grow, and each is created exclusively."""
        now = time.time() if now is None else now
        term, held = self._held()
        if held["owner"] not in (owner, "") and held["until"] > now:
            raise Conflict(f"{held['owner']} holds the lease")
        if not self._create(f"_lease/{term + 1:020d}.json", {"owner": owner, "until": now + LEASE_SECONDS}):
            raise Conflict("another writer took the lease")
        self.owner, self.term = owner, term + 1
        return term + 1

    def release(self, owner: str) -> None:
        self.acquire(owner)
        self._create(f"_lease/{self.term + 1:020d}.json", {"owner": "", "until": 0})
        self.owner, self.term = None, 0

    def _may_write(self) -> None:
        """A commit is for the lease's holder. A store that never took a lease may write while nobody holds one."""
        term, held = self._held()
        if self.term and term != self.term:
            raise Conflict("the lease has been taken over")
        if held["owner"] not in ("", self.owner) and held["until"] > time.time():
            raise Conflict(f"{held['owner']} holds the lease")

    # Commits

    @contextmanager
    def watched(self, seconds: float) -> Iterator[None]:
        """A commit that hangs is ended: its Spark jobs are cancelled, and an alert names the stage."""
        sc, tag = self.spark.sparkContext, f"commit-{uuid.uuid4().hex}"

        def bark() -> None:
            self.alert("commit_hung", f"no end of {self.stage} within {seconds} s")
            sc.cancelJobsWithTag(tag)

        timer = threading.Timer(seconds, bark)
        timer.daemon = True
        sc.addJobTag(tag)
        timer.start()
        try:
            yield
        finally:
            timer.cancel()
            sc.removeJobTag(tag)

    def commit(self, changes: dict[str, dict], resume: dict | None = None, batch_id: int | None = None, audit: dict | None = None, states: dict[str, dict] | None = None, watchdog: float = WATCHDOG_SECONDS) -> int:
        """One atomic commit. changes: by table, `rename` ({old: new}) and `drop_columns`, then any of `upserts` and `deletes` with
        `keys` (after `truncate`, if so wanted), `append`, `replace` (keyed if `keys` are given), `drop`; `shadow`: `open`, `swap`
        or `discard`. While a table's shadow is open, its rows go there. states: of tables' images, each an edge of their lifecycle.

        A batch that is already recorded is not applied again: the current commit id is returned."""
        began = time.time()
        if self.owner:
            self.acquire(self.owner)
        self._may_write()
        state = self.latest()
        if batch_id is not None and batch_id <= state["batches"]:
            return state["commit_id"]
        commit_id, counts = state["commit_id"] + 1, {}
        new = json.loads(json.dumps(state)) | {"commit_id": commit_id}
        with self.watched(watchdog):
            for name, change in changes.items():
                self.fault("before_table")
                counts[name] = self._apply(new, name, change, commit_id)
                self.fault("after_table")
            for name, to in (states or {}).items():
                self._enter(new, name, to)
            row = {
                "commit_id": commit_id, "pipeline": self.pipeline, "phase": "stream", "trigger": None, "event_count": None, "unit_count": None, "fenced_units": 0, "fenced_events": 0,
                "first_txn_id": None, "last_txn_id": None, "first_lsn": None, "last_lsn": None, "max_source_ts": None, "snapshot_epoch": new["epoch"], "tables_touched": sorted(changes),
                "rows": counts, "runner_id": self.owner, "spilled": False, "opened_at": began, "committed_at": time.time(), "resume": resume or state["resume"],
            } | (audit or {})
            new |= {"resume": resume or state["resume"], "batches": state["batches"] if batch_id is None else batch_id, "audit": row, "owner": self.owner}
            self.fault("before_publish")
            self._may_write()
            if not self._create(f"_manifest/{commit_id:020d}.json", new):
                raise Conflict(f"commit {commit_id} was made by another writer")
        self.fault("after_publish")
        return commit_id

    def _enter(self, new: dict, name: str, to: dict) -> None:
        old = new["states"].get(name, {"state": "absent"})
        MACHINES["table_lifecycle"].to(old["state"], to["state"])
        new["states"][name] = old | to

    def _apply(self, new: dict, name: str, change: dict, commit_id: int) -> int:
        """One table's change in the manifest to be; how many rows were written."""
        if change.get("shadow") == "open":
            # A stale shadow goes, and the image is of a new epoch.
            new["epoch"] += 1
            new["shadows"][name] = {"entry": None, "epoch": new["epoch"]}
            self._enter(new, name, {"state": "in_progress", "epoch": new["epoch"]})
        if change.get("shadow") == "discard":
            new["shadows"].pop(name, None)
            return 0
        if change.get("shadow") == "swap":
            held = new["shadows"].pop(name)
            old = new["tables"].pop(name, None)
            if held["entry"] or old:  # an empty image leaves a table without rows
                new["tables"][name] = held["entry"] or old | {"versions": {} if isinstance(old["versions"], dict) else [], "deltas": [], "rows": 0}
            self._enter(new, name, {"state": "complete", "snapshot_lsn": change.get("snapshot_lsn"), "epoch": held["epoch"]})
            return 0
        if change.get("drop"):
            new["tables"].pop(name, None)
            new["shadows"].pop(name, None)
            return 0
        open_shadow = new["shadows"].get(name)
        entry = open_shadow["entry"] if open_shadow else new["tables"].get(name)
        if entry:
            entry = self._reshaped(entry, change, commit_id)
        n = 0
        if {"append", "replace", "upserts", "deletes", "truncate"} & set(change):
            entry, n = self._rows(entry, change, commit_id, f"tables/{name}/v{commit_id:020d}-{uuid.uuid4().hex[:8]}")
        if entry and open_shadow:
            open_shadow["entry"] = entry
        elif entry:
            new["tables"][name] = entry
        return n

    @staticmethod
    def _reshaped(entry: dict, change: dict, commit_id: int) -> dict:
        entry = json.loads(json.dumps(entry))
        for column in change.get("drop_columns", []):
            if column in (entry["keys"] or []):
                raise SchemaRefusal(f"{column} is part of the identity")
            if column in entry["columns"]:
                entry["columns"].remove(column)
                entry["types"].pop(column), entry["physical"].pop(column)
        for old, to in change.get("rename", {}).items():
            if to in entry["columns"]:
                raise SchemaRefusal(f"{to} exists; rows under both names have to be merged and the table replaced")
            if old in entry["columns"]:
                entry["columns"][entry["columns"].index(old)] = to
                entry["types"][to], entry["physical"][to] = entry["types"].pop(old), entry["physical"].pop(old)
                entry["keys"] = entry["keys"] and [to if k == old else k for k in entry["keys"]]
        return entry

    def _rows(self, old: dict | None, change: dict, commit_id: int, version: str) -> tuple[dict, int]:
        keys = change.get("keys")
        if "append" in change or "replace" in change and not keys:
            rows = change.get("append", change.get("replace"))
            old = old if "append" in change else None
            wider = {c: t for c, t in rows.dtypes if old and old["types"].get(c, t) != t}
            if wider:  # one type a column: the table is written anew
                held = self._load(old)
                rows, old = held.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in wider.items()}).unionByName(rows, allowMissingColumns=True), None
            entry = self._shaped(old, rows, None, commit_id)
            self._named(entry, rows).write.parquet(f"{self.root}/{version}")
            self.fault("after_stage")
            n = self._files(entry, [version]).count()
            entry["versions"], entry["rows"] = [*entry["versions"], version], entry["rows"] + n
            return entry, n
        if "replace" in change:
            old, change = None, change | {"upserts": change["replace"]}
        return self._merge(old, change, keys, commit_id, version)

    @staticmethod
    def _shaped(old: dict | None, rows: DataFrame, keys: list[str] | None, commit_id: int) -> dict:
        """The entry of a table that also holds rows' columns. A column that was dropped before comes back under a new physical
        name, lest its old values do."""
        entry = json.loads(json.dumps(old)) if old else {"versions": {} if keys else [], "columns": [], "types": {}, "physical": {}, "deltas": [], "rows": 0, "buckets": 0}
        for c, kind in rows.dtypes:
            if c not in entry["columns"]:
                entry["columns"].append(c)
                entry["physical"][c] = f"{c}__{commit_id}" if old else c
            entry["types"][c] = kind
        return entry | {"keys": keys}

    @staticmethod
    def _named(entry: dict, rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*[F.col(f"`{c}`").alias(entry["physical"][c]) for c in rows.columns if c not in more], *more)

    def _merge(self, old: dict | None, change: dict, keys: list[str], commit_id: int, version: str) -> tuple[dict, int]:
        """A keyed table's next version."""
        upserts, deletes = change.get("upserts"), change.get("deletes")
        if upserts is None:
            upserts = self._empty(old) if old else deletes.limit(0)
        entry = self._shaped(old, upserts, keys, commit_id)
        staged = upserts.withColumn(DELETED, F.lit(False))
        if deletes is not None:
            staged = staged.unionByName(deletes.select(*keys).distinct().withColumn(DELETED, F.lit(True)), allowMissingColumns=True)
        staged = staged.withColumn(COMMIT, F.lit(commit_id).cast("long"))
        self._named(entry, staged, DELETED, COMMIT).write.parquet(f"{self.root}/{version}/delta")
        self.fault("after_stage")
        staged = self._files(entry, [f"{version}/delta"], (DELETED, COMMIT))
        if not fold.duplicates(staged.where(~F.col(DELETED)), keys).isEmpty():
            raise IdentityViolation("an identity would occur twice")
        n, placed = staged.agg(F.count("*"), F.count_if(~F.col(DELETED))).first()
        fresh = old is None or change.get("truncate") or not old["versions"] and not old["deltas"]
        retyped = old is not None and any(old["types"].get(c, t) != t for c, t in entry["types"].items())
        if not fresh and not retyped and n <= DELTA_SHARE * old["rows"] and len(old["deltas"]) < MOST_DELTAS:
            # Rows are counted exactly when buckets are written; until then this is their upper bound.
            return entry | {"deltas": [*old["deltas"], f"{version}/delta"], "rows": old["rows"] + placed}, n
        rows, buckets = staged.where(~F.col(DELETED)).drop(DELETED, COMMIT), self._how_many(0 if fresh else old["rows"], placed, None if fresh else old["buckets"])
        touched = None
        if fresh:
            rows, entry["versions"] = rows, {}
        else:
            if buckets == old["buckets"] and not retyped:
                changed = staged.select(*keys)
                if old["deltas"]:
                    changed = changed.unionByName(self._files(old, old["deltas"]).select(*keys))
                touched = sorted(r.b for r in changed.select(self._bucket(keys, buckets).alias("b")).distinct().collect())  # at most one a bucket
            held = self._load(old, touched)
            held = held.withColumns({c: F.col(f"`{c}`").cast(entry["types"][c]) for c in held.columns if old["types"][c] != entry["types"][c]})
            rows = fold.merge(held, rows, staged.where(DELETED).select(*keys), keys)
        out = self._named(entry, rows.withColumn(BUCKET, self._bucket(keys, buckets)), BUCKET)
        out.repartition(max(1, buckets if touched is None else len(touched)), BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{version}/base")
        self.fault("after_merge")
        sizes = {str(r[BUCKET]): r.n for r in self.spark.read.schema(out.schema).parquet(f"{self.root}/{version}/base").groupBy(BUCKET).agg(F.count("*").alias("n")).collect()}
        kept = {} if touched is None else {k: v for k, v in entry["versions"].items() if int(k) not in touched}
        counted = {} if touched is None else {k: v for k, v in entry.get("sizes", {}).items() if int(k) not in touched}
        entry |= {"versions": kept | {k: f"{version}/base/{BUCKET}={k}" for k in sizes}, "sizes": counted | sizes, "deltas": [], "buckets": buckets}
        entry["rows"] = sum(entry["sizes"].values())
        return entry, n

    def _how_many(self, held: int, more: int, now: int | None) -> int:
        """Buckets for a table: by its size, and twice as many as now once they hold twice the rows they should."""
        want = max(LEAST_BUCKETS, min(MOST_BUCKETS, -(-(held + more) // self.bucket_rows)))
        if now is None:
            return self.buckets or want
        return now if want <= 2 * now else min(MOST_BUCKETS, max(2 * now, want))

    # Images: shadows and owed tables

    def transition(self, states: dict[str, dict]) -> int:
        return self.commit({}, states=states)

    def owed(self) -> list[str]:
        """Tables whose image isn't complete."""
        return sorted(t for t, s in self.latest()["states"].items() if s["state"] in ("in_progress", "awaiting_snapshot"))

    def watermarks(self) -> dict[str, int]:
        """The positions that complete images hold."""
        return {t: s["snapshot_lsn"] for t, s in self.latest()["states"].items() if s["state"] == "complete" and s.get("snapshot_lsn") is not None}

    def recover(self) -> list[str]:
        """At start: images that were in progress are owed anew, requests for images are adopted, stale shadows go."""
        state = self.latest()
        asked = {t for n in self._names("_requests") for t in self._read(f"_requests/{n}")["tables"]}
        owing = {t: {"state": "awaiting_snapshot"} for t, s in state["states"].items() if s["state"] == "in_progress" or (t in asked and s["state"] != "awaiting_snapshot")}
        owing |= {t: {"state": "awaiting_snapshot"} for t in asked if t not in state["states"]}
        if owing or state["shadows"]:
            self.commit({t: {"shadow": "discard"} for t in state["shadows"]}, states=owing, audit={"phase": "recovery"})
        for n in self._names("_requests"):
            self._fs.delete(self._path(f"_requests/{n}"), False)
        return self.owed()

    # Beside the commits: what has to outlive a refused group

    def alert(self, code: str, message: str) -> None:
        self._create(f"_alerts/{time.time_ns():020d}-{uuid.uuid4().hex[:6]}.json", {"pipeline": self.pipeline, "code": code, "message": message})

    def alerts(self) -> list[dict]:
        return [self._read(f"_alerts/{n}") for n in self._names("_alerts")]

    def request_image(self, tables: list[str], reason: str) -> None:
        """A durable request for new images, adopted by recover()."""
        self._create(f"_requests/{time.time_ns():020d}-{uuid.uuid4().hex[:6]}.json", {"tables": sorted(tables), "reason": reason})

    def journal(self, machine: str, to: str | None = None, **context) -> dict:
        """The last durable phase of a machine (say, acquisition_recovery or interruption_marker); with `to`, enters that phase
        first, by a legal edge only, and by one writer only."""
        m, names = MACHINES[machine], self._names(f"_journal/{machine}")
        last = self._read(f"_journal/{machine}/{names[-1]}") if names else {"phase": m.initial}
        if to is None:
            return last
        new = {"phase": m.to(last["phase"], to), "at": time.time()} | context
        if not self._create(f"_journal/{machine}/{len(names) + 1:020d}.json", new):
            raise Conflict(f"another writer moved {machine}")
        return new

    def vacuum(self, keep: int = 10, age_seconds: float = 3600) -> int:
        """Deletes files that none of the last `keep` manifests names and that are older than age_seconds, and older manifests, whose
        audit rows are kept together. Returns how many versions went."""
        ids = self._manifests()
        gone = ids[:-keep] if keep < len(ids) else []
        rows = [self._read(f"_manifest/{i:020d}.json")["audit"] for i in gone]
        if gone:
            self._create(f"_audit/{gone[0]:020d}-{gone[-1]:020d}.json", rows)
        named = set()
        for i in ids[-keep:]:
            m = self.manifest(i)
            for entry in [*m["tables"].values(), *(s["entry"] for s in m["shadows"].values() if s["entry"])]:
                parts = entry["versions"]
                named |= {"/".join(p.split("/")[:3]) for p in [*(parts.values() if isinstance(parts, dict) else parts), *entry["deltas"]]}
        for i in gone:
            self._fs.delete(self._path(f"_manifest/{i:020d}.json"), False)
        dropped, before = 0, (time.time() - age_seconds) * 1000
        for table in self._names("tables", ""):
            for s in self._fs.listStatus(self._path(f"tables/{table}")):
                if f"tables/{table}/{s.getPath().getName()}" not in named and s.getModificationTime() <= before:
                    self._fs.delete(s.getPath(), True)
                    dropped += 1
        return dropped
