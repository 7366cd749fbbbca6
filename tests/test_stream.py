"""Change streams applied to a store: whole transactions once, the physical fold, truncates, refusals."""

import pytest

from changelake.store import AmbiguousDelete, Store
from changelake.streaming import apply
from changelake.streaming.apply import AssemblyError, Table

USERS = {"app.users": Table("users", {"id": "bigint", "v": "string"}, ("id",))}
LOGS = {"app.hits": Table("hits", {"id": "bigint", "v": "string"})}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


class Stream:
    """Records as a serial source sends them."""

    def __init__(self, spark, table="app.users", lsn=0):
        self.spark, self.table, self.seq, self.lsn = spark, table, 0, lsn

    def _one(self, **r):
        self.seq += 1
        self.lsn += 1
        names = [f.split()[0] for f in apply.RECORD.split(", ")]
        return tuple(({"seq": self.seq, "lsn": self.lsn, "source_ts_ms": self.lsn} | r).get(n) for n in names)

    def events(self, txn, *ops, first=1):
        out = []
        for k, (op, row_id, v) in enumerate(ops):
            image = None if row_id is None else {"id": str(row_id)} | ({"v": v} if v is not None else {})
            out.append(self._one(kind="truncate" if op == "t" else "data", src_table=self.table, op=op, txn_id=str(txn), total_order=first + k, before=image if op == "d" else None, row=image if op in "cur" else None))
        return out

    def end(self, txn, n):
        return [self._one(kind="txn_end", txn_id=str(txn), event_count=n, data_collections={self.table: n})]

    def txn(self, txn, *ops):
        return self.events(txn, *ops) + self.end(txn, len(ops))

    def frame(self, records):
        return self.spark.createDataFrame(records, apply.RECORD)


def applied(spark, tmp_path, held, *txns):
    """The rows of users after one batch of transactions on what is held."""
    store, s = Store(spark, f"file://{tmp_path}"), Stream(spark)
    run = apply.apply_batch(store, USERS)
    if held:
        run(s.frame(s.txn(1, *[("c", k, v) for k, v in held.items()])), 0)
    run(s.frame([r for n, ops in enumerate(txns) for r in s.txn(n + 2, *ops)]), 1)
    return {i: v for i, v in rows(store.table("users").select("id", "v"))}, store


def test_keys_are_reused_within_a_transaction(spark, tmp_path):
    got, _ = applied(spark, tmp_path, {20: "a", 21: "b"}, [("d", 20, "a"), ("c", 21, "a"), ("d", 21, "b"), ("c", 22, "b")])
    assert got == {21: "a", 22: "b"}


def test_rings_and_swaps_through_a_temporary_key(spark, tmp_path):
    swap = [("d", 1, "a"), ("c", 9, "a"), ("d", 2, "b"), ("c", 1, "b"), ("d", 9, "a"), ("c", 2, "a")]
    ring = [("d", 1, "b"), ("c", 2, "b"), ("d", 2, "a"), ("c", 3, "a"), ("d", 3, "c"), ("c", 1, "c")]
    got, store = applied(spark, tmp_path, {1: "a", 2: "b", 3: "c"}, swap, ring)
    assert got == {1: "c", 2: "b", 3: "a"}
    assert store.log()[-1]["unit_count"] == 2 and store.log()[-1]["event_count"] == 12


def test_untouched_rows_keep_their_origin(spark, tmp_path):
    got, store = applied(spark, tmp_path, {1: "a", 2: "b"}, [("d", 1, "a"), ("c", 2, "a"), ("d", 2, "a"), ("c", 5, "a")])
    assert got == {2: "b", 5: "a"}
    assert rows(store.table("users").select("id", "cdcf_commit_id")) == [(2, 1), (5, 2)]


def test_truncates(spark, tmp_path):
    got, store = applied(spark, tmp_path, {1: "x", 2: "y", 3: "z"}, [("c", 60, "p"), ("t", None, None), ("c", 61, "q"), ("c", 62, "r"), ("t", None, None), ("c", 63, "s")])
    assert got == {63: "s"}
    assert rows(store.table(apply.EVENTS).select("event", "rows_removed", "applied")) == [("TRUNCATE", 2, True), ("TRUNCATE", 4, True)]
    log = {"app.users": Table("users", USERS["app.users"].columns, ("id",), truncate_mode="log")}
    s = Stream(spark, lsn=100)
    apply.apply_batch(store, log)(s.frame(s.txn(9, ("t", None, None), ("c", 64, "t"))), 2)
    assert rows(store.table("users").select("id")) == [(63,), (64,)]
    assert rows(store.table(apply.EVENTS).where("NOT applied").select("event")) == [("TRUNCATE",)]


def test_a_truncate_alone_invents_no_table(spark, tmp_path):
    store, s = Store(spark, f"file://{tmp_path}"), Stream(spark)
    apply.apply_batch(store, USERS)(s.frame(s.txn(1, ("t", None, None))), 0)
    assert store.table("users") is None and store.latest()["resume"]["last_lsn"] == 2


def test_what_cant_be_told_apart_is_refused(spark, tmp_path):
    with pytest.raises(AmbiguousDelete):
        applied(spark, tmp_path, {1: "a", 2: "b"}, [("d", 1, "a"), ("c", 3, "a"), ("d", 2, "b"), ("c", 3, "b"), ("d", 3, "z")])
    store = Store(spark, f"file://{tmp_path}")
    assert rows(store.table("users").select("id", "v")) == [(1, "a"), (2, "b")] and store.alerts()[-1]["code"] == "ambiguous_fold"
    assert store.recover() == ["users"]


def test_a_stream_in_pieces(spark, tmp_path):
    store, s = Store(spark, f"file://{tmp_path}"), Stream(spark)
    run = apply.apply_batch(store, USERS)
    first = s.txn(1, ("c", 1, "a"), ("c", 2, "b")) + s.events(2, ("u", 1, "c"))
    run(s.frame(first), 0)
    assert rows(store.table("users").select("id", "v")) == [(1, "a"), (2, "b")]
    assert store.table(apply.OPEN).count() == 1 and store.latest()["resume"]["last_lsn"] == 3
    rest = s.events(2, ("d", 2, None), ("c", 3, "d"), first=2) + s.end(2, 3)
    run(s.frame(rest), 1)
    assert rows(store.table("users").select("id", "v")) == [(1, "c"), (3, "d")]
    assert store.table(apply.OPEN).count() == 0 and store.latest()["resume"] == {"last_lsn": 7, "last_txn_id": "2", "last_total_order": 3}
    before = store.latest()["commit_id"]
    run(s.frame(rest), 1)
    assert store.latest()["commit_id"] == before
    run(s.frame(first[:3]), 2)  # sent again by the source
    assert rows(store.table("users").select("id", "v")) == [(1, "c"), (3, "d")] and store.log()[-1]["fenced_units"] == 1


BROKEN = {
    "another transaction without END": lambda s: s.events(1, ("c", 1, "a")) + s.txn(2, ("c", 2, "b")),
    "END of another transaction": lambda s: s.events(1, ("c", 1, "a")) + s.end(2, 1),
    "no ordinal": lambda s: [(*r[:6], None, *r[7:]) if r[1] == "data" else r for r in s.txn(1, ("c", 1, "a"))],
    "ordinal below 1": lambda s: s.events(1, ("c", 1, "a"), first=0) + s.end(1, 1),
    "no transaction id": lambda s: [(*r[:5], None, *r[6:]) if r[1] == "data" else r for r in s.txn(1, ("c", 1, "a"))],
    "ordinal given twice": lambda s: s.events(1, ("c", 1, "a")) + s.events(1, ("c", 2, "a")) + s.end(1, 2),
    "event count": lambda s: s.events(1, ("c", 1, "a")) + s.end(1, 2),
    "ordinals": lambda s: s.events(1, ("c", 1, "a")) + s.events(1, ("c", 2, "a"), first=3) + s.end(1, 2),
    "table counts": lambda s: s.events(1, ("c", 1, "a")) + [(*s.end(1, 1)[0][:-1], {"app.users": 2})],
    "BEGIN while a transaction is open": lambda s: s.events(1, ("c", 1, "a")) + [s._one(kind="txn_begin", txn_id="2")],
}


@pytest.mark.parametrize("rule", list(BROKEN))
def test_broken_streams_are_refused(spark, tmp_path, rule):
    store, s = Store(spark, f"file://{tmp_path}"), Stream(spark)
    with pytest.raises(AssemblyError, match=rule):
        apply.apply_batch(store, USERS, parts=3)(s.frame(BROKEN[rule](s)), 0)
    assert store.latest()["commit_id"] == 0 and len(store.alerts()) == 1


def test_late_events_are_not_lost_silently(spark, tmp_path):
    store, s = Store(spark, f"file://{tmp_path}"), Stream(spark)
    run, part = apply.apply_batch(store, USERS), s.events(1, ("c", 1, "a"))
    run(s.frame(part), 0)
    with pytest.raises(AssemblyError):
        run(s.frame(s.txn(2, ("c", 2, "b"))), 1)
    assert store.table("users") is None and store.table(apply.OPEN).count() == 1 and store.latest()["resume"] is None


def test_logs_without_a_key_and_image_fences(spark, tmp_path):
    store, s = Store(spark, f"file://{tmp_path}"), Stream(spark, "app.hits")
    run = apply.apply_batch(store, LOGS)
    run(s.frame(s.txn(1, ("c", 1, "a"), ("u", 1, "b"), ("d", 1, "b"))), 0)
    assert rows(store.table("hits").select("id", "v", "dbz_op", "cdcf_event_id")) == [(1, "a", "c", "1:1:1"), (1, "b", "d", "3:1:3"), (1, "b", "u", "2:1:2")]
    run(s.frame(s.txn(2, ("c", 2, "x"), ("t", None, None), ("c", 3, "y"))), 1)
    assert rows(store.table("hits").select("id")) == [(3,)] and rows(store.table(apply.EVENTS).select("rows_removed")) == [(4,)]
    store.commit({"hits": {"shadow": "open"}})
    store.commit({"hits": {"shadow": "swap", "snapshot_lsn": 1000}})
    run(s.frame(s.txn(3, ("c", 4, "held by the image"))), 2)
    assert store.table("hits").count() == 0 and store.latest()["resume"]["last_lsn"] == 10


def test_follow(spark, tmp_path):
    store, s = Store(spark, f"file://{tmp_path}/store"), Stream(spark)
    s.frame(s.txn(1, ("c", 1, "a")) + s.events(2, ("u", 1, "b"))).coalesce(1).write.parquet(f"{tmp_path}/log", mode="append")
    stream = spark.readStream.schema(apply.RECORD).parquet(f"{tmp_path}/log")
    query = apply.follow(stream, store, USERS, f"file://{tmp_path}/checkpoint")
    assert apply.bounded(query, 120) == "work_done" and not apply.unflushed(store, query)
    s.frame(s.end(2, 1)).coalesce(1).write.parquet(f"{tmp_path}/log", mode="append")
    assert apply.bounded(apply.follow(stream, store, USERS, f"file://{tmp_path}/checkpoint"), 120) == "work_done"
    assert rows(store.table("users").select("id", "v")) == [(1, "b")]
