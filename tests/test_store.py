"""The store: atomic commits, faults between stages, leases, and streams applied once."""

import pytest
from pyspark.sql import functions as F

from changelake import machines
from changelake.functions import naming
from changelake.operators import evolution
from changelake.sources.changelog import decode
from changelake import store as store_module
from changelake.store import Conflict, IdentityViolation, SchemaRefusal, Store


class Crash(RuntimeError):
    pass


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, data, schema="id long, v string"):
    return spark.createDataFrame(data, schema)


def test_commits_are_atomic_over_tables(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    assert store.table("a") is None and store.latest()["commit_id"] == 0
    store.commit({"a": {"upserts": frame(spark, [(1, "x"), (2, "y")]), "keys": ["id"]}, "log": {"append": frame(spark, [(1, "x")])}}, {"last_lsn": 5})
    store.commit({"a": {"upserts": frame(spark, [(2, "z"), (None, "n")]), "deletes": frame(spark, [(1,)], "id long"), "keys": ["id"]}, "log": {"append": frame(spark, [(2, "z")])}}, {"last_lsn": 9})
    assert rows(store.table("a").where("id is not null")) == [(2, "z")]
    assert rows(store.table("log")) == [(1, "x"), (2, "z")]
    assert store.latest()["resume"] == {"last_lsn": 9}
    assert [a["commit_id"] for a in store.log()] == [1, 2]
    store.commit({"a": {"upserts": frame(spark, [(None, "m")]), "keys": ["id"]}})
    assert store.table("a").where("id is null").count() == 1
    store.commit({"a": {"drop": True}})
    assert store.table("a") is None and store.latest()["resume"] == {"last_lsn": 9}


@pytest.mark.parametrize("anchor, applied", [("after_stage", False), ("before_publish", False), ("after_publish", True)])
def test_a_crash_leaves_all_or_nothing(spark, tmp_path, anchor, applied):
    def fault(at):
        if at == anchor:
            raise Crash(at)

    Store(spark, f"file://{tmp_path}").commit({"a": {"upserts": frame(spark, [(1, "x")]), "keys": ["id"]}}, {"last_lsn": 1}, batch_id=0)
    change = {"a": {"upserts": frame(spark, [(1, "y"), (2, "z")]), "keys": ["id"]}}
    with pytest.raises(Crash):
        Store(spark, f"file://{tmp_path}", fault=fault).commit(change, {"last_lsn": 2}, batch_id=1)
    store = Store(spark, f"file://{tmp_path}")
    assert store.latest()["resume"] == {"last_lsn": 2 if applied else 1}
    assert store.commit(change, {"last_lsn": 2}, batch_id=1) == 2
    assert rows(store.table("a")) == [(1, "y"), (2, "z")]
    assert len(store.log()) == 2


def test_conflicts_identities_and_leases(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    with pytest.raises(IdentityViolation):
        store.commit({"a": {"upserts": frame(spark, [(1, "x"), (1, "y")]), "keys": ["id"]}})
    assert store.table("a") is None

    def other(at):
        if at == "before_publish":
            Store(spark, f"file://{tmp_path}").commit({"b": {"append": frame(spark, [(1, "x")])}})

    with pytest.raises(Conflict):
        Store(spark, f"file://{tmp_path}", fault=other).commit({"b": {"append": frame(spark, [(2, "x")])}})
    assert rows(store.table("b")) == [(1, "x")]
    store.acquire("one", now=100)
    with pytest.raises(Conflict):
        store.acquire("two", now=130)
    store.acquire("one", now=150)
    store.acquire("two", now=500)
    store.alert("code", "message")
    assert [a["code"] for a in store.alerts()] == ["code"]


def test_small_commits_write_their_changes_only(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", buckets=16)
    store.commit({"a": {"upserts": frame(spark, [(i, "x") for i in range(200)]), "keys": ["id"]}})
    before = store.latest()["tables"]["a"]["versions"]
    store.commit({"a": {"upserts": frame(spark, [(3, "y")]).withColumn("w", F.lit(1)), "deletes": frame(spark, [(9,)], "id long"), "keys": ["id"]}})
    after = store.latest()["tables"]["a"]
    assert len(before) == 16 and after["versions"] == before and len(after["deltas"]) == 1
    assert store.table("a").count() == 199 and rows(store.table("a").where("id in (3, 4, 9)")) == [(3, "y", 1), (4, "x", None)]
    for k in range(store_module.MOST_DELTAS):
        store.commit({"a": {"upserts": frame(spark, [(3, f"y{k}")]), "keys": ["id"]}})
    entry = store.latest()["tables"]["a"]
    assert not entry["deltas"] and entry["rows"] == 199 and sum(before[k] != entry["versions"][k] for k in before) == 2
    assert rows(store.table("a").where("id in (3, 9)")) == [(3, f"y{k}", None)]
    store.commit({"a": {"upserts": frame(spark, [(5, "z", 1.5)], "id long, v string, w double"), "keys": ["id"]}})
    assert rows(store.table("a").where("w is not null")) == [(5, "z", 1.5)] and store.table("a").count() == 199
    store.commit({"a": {"deletes": frame(spark, [(i, "x") for i in range(200)]).select("id"), "keys": ["id"]}})
    assert store.table("a").count() == 0 and store.table("a").columns == ["id", "v", "w"]


def test_buckets_follow_the_size(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", bucket_rows=10)
    store.commit({"a": {"upserts": frame(spark, [(i, "x") for i in range(100)]), "keys": ["id"]}})
    assert store.latest()["tables"]["a"]["buckets"] == 10
    store.commit({"a": {"upserts": frame(spark, [(i, "y") for i in range(90, 400)]), "keys": ["id"]}})
    entry = store.latest()["tables"]["a"]
    assert entry["buckets"] > 20 and entry["rows"] == store.table("a").count() == 400 and store.table("a").where("v = 'y'").count() == 310


def test_a_lease_keeps_other_writers_out(spark, tmp_path):
    one, two = Store(spark, f"file://{tmp_path}"), Store(spark, f"file://{tmp_path}")
    one.acquire("one")
    with pytest.raises(Conflict):
        two.commit({"a": {"append": frame(spark, [(1, "x")])}})
    one.commit({"a": {"append": frame(spark, [(1, "x")])}})
    one.release("one")
    two.acquire("two")
    two.commit({"a": {"append": frame(spark, [(2, "x")])}})
    one.owner, one.term = "one", 1
    with pytest.raises(Conflict):
        one.commit({"a": {"append": frame(spark, [(3, "x")])}})
    assert rows(one.table("a").select("id")) == [(1,), (2,)]


def test_columns_are_renamed_dropped_and_come_back_empty(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.commit({"a": {"upserts": frame(spark, [(1, "x"), (2, "y")]), "keys": ["id"]}})
    store.commit({"a": {"rename": {"v": "w"}}})
    assert rows(store.table("a")) == [(1, "x"), (2, "y")] and store.table("a").columns == ["id", "w"]
    store.commit({"a": {"drop_columns": ["w"]}})
    assert store.table("a").columns == ["id"]
    store.commit({"a": {"upserts": frame(spark, [(2, "z")], "id long, w string"), "keys": ["id"]}})
    assert rows(store.table("a").where("w IS NOT NULL")) == [(2, "z")]
    with pytest.raises(SchemaRefusal):
        store.commit({"a": {"drop_columns": ["id"]}})
    with pytest.raises(SchemaRefusal):
        store.commit({"a": {"rename": {"id": "w"}}})
    store.commit({"a": {"rename": {"id": "key"}}})
    store.commit({"a": {"replace": store.table("a").select("key", F.upper("w").alias("w")), "keys": ["key"]}})
    assert rows(store.table("a").where("w IS NOT NULL")) == [(2, "Z")] and store.describe("a")["keys"] == ["key"]
    with pytest.raises(IdentityViolation):
        store.commit({"a": {"replace": store.table("a").withColumn("same", F.lit(1)), "keys": ["same"]}})


def test_shadows_swap_and_interrupted_images(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.commit({"a": {"upserts": frame(spark, [(1, "old"), (2, "old")]), "keys": ["id"]}})
    store.commit({"a": {"shadow": "open"}})
    store.commit({"a": {"upserts": frame(spark, [(1, "new"), (3, "new")]), "keys": ["id"]}})
    store.commit({"a": {"upserts": frame(spark, [(3, "later")]), "keys": ["id"]}})
    assert rows(store.table("a")) == [(1, "old"), (2, "old")] and rows(store.shadow("a")) == [(1, "new"), (3, "later")]
    assert store.owed() == ["a"] and store.watermarks() == {}
    store.commit({"a": {"shadow": "swap", "snapshot_lsn": 70}})
    assert rows(store.table("a")) == [(1, "new"), (3, "later")] and store.shadow("a") is None
    assert store.owed() == [] and store.watermarks() == {"a": 70} and store.latest()["epoch"] == 1
    store.commit({"a": {"shadow": "open"}})
    with pytest.raises(machines.IllegalTransition):  # a half image has to be owed before another begins
        store.commit({"a": {"shadow": "open"}})
    store.request_image(["b"], "asked for")
    assert store.recover() == ["a", "b"] and store.latest()["shadows"] == {} and store.table("a").count() == 2
    store.commit({"a": {"shadow": "open"}})
    store.commit({"a": {"shadow": "swap", "snapshot_lsn": 90}})
    assert store.table("a").count() == 0 and store.watermarks() == {"a": 90}


def test_vacuum_probe_journal_and_old_layouts(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    assert store.probe()
    for k in range(5):
        store.commit({"a": {"replace": frame(spark, [(k, "x")]), "keys": ["id"]}})
    assert store.vacuum(keep=2, age_seconds=0) == 3
    assert rows(store.table("a")) == [(4, "x")] and [r["commit_id"] for r in store.log()] == [1, 2, 3, 4, 5]
    assert store.journal("acquisition_recovery")["phase"] == "absent"
    store.journal("acquisition_recovery", "requested")
    with pytest.raises(machines.IllegalTransition):
        store.journal("acquisition_recovery", "armed")
    old = store_module.migrated({"commit_id": 3, "tables": {"a": {"versions": {"1": "x"}, "columns": ["id"], "keys": ["id"], "types": {"id": "bigint"}}}, "resume": None, "batches": 2})
    assert old["layout"] == store_module.LAYOUT and old["tables"]["a"]["buckets"] == 8 and old["tables"]["a"]["physical"] == {"id": "id"}


def test_a_commit_that_hangs_is_named(spark, tmp_path):
    import time

    store = Store(spark, f"file://{tmp_path}", fault=lambda at: time.sleep(1.5) if at == "before_publish" else None)
    store.commit({"a": {"append": frame(spark, [(1, "x")])}}, watchdog=0.5 + 30 * 0)
    assert any(a["code"] == "commit_hung" for a in store.alerts())


def test_machines():
    for m in machines.MACHINES.values():
        assert m.reachable() | {"not_required"} >= m.states - {"valid"} or m.name == "snapshot_completion", m.name
        assert m.terminal <= m.states
        for a, b in m.edges:
            assert m.to(a, b) == b
    with pytest.raises(machines.IllegalTransition):
        machines.MACHINES["table_lifecycle"].to("none", "complete")
    with pytest.raises(machines.IllegalTransition):
        machines.MACHINES["run_phase"].to("starting", "sleeping")
    assert machines.outcome("idle", "engine_error", "hung") == "engine_error"


def test_names():
    assert naming.snake_case("fooBar Baz-9") == "foo_bar_baz_9"
    assert naming.snake_case("9lives") == "_9lives"
    assert naming.destination_table("app", "public", "OrderItems") == "app_public_order_items"


def test_malformed_envelopes_fail(spark):
    good = [("app.public.t", "{}", '{"op":"c","after":{"id":1},"source":{"lsn":5,"txId":7,"table":"t"}}'), ("app.transaction", None, '{"status":"END","id":"7:9","event_count":1,"data_collections":[{"data_collection":"public.t","event_count":1}]}')]
    found = decode(frame(spark, good, "topic string, key string, value string"), "app").orderBy("kind").collect()
    assert [(r.kind, r.txn_id) for r in found] == [("data", "7"), ("txn_end", "7")]
    assert found[0].after_json == '{"id":1}' and found[1].data_collections == {"public.t": 1}
    with pytest.raises(Exception, match="(?i)malformed"):
        decode(frame(spark, [("app.public.t", "{}", "{oops")], "topic string, key string, value string"), "app").collect()


def test_ensure_widens_or_refuses(spark):
    df = frame(spark, [(1, "x")])
    out = evolution.ensured(df, {"id": "DOUBLE", "v": "VARCHAR", "new": "JSON"})
    assert dict(out.dtypes) == {"id": "double", "v": "string", "new": "string"}
    with pytest.raises(TypeError):
        evolution.ensured(df, {"id": "DOUBLE"}, strict=True)
    with pytest.raises(TypeError):
        evolution.ensured(df.withColumn("id", F.current_date()), {"id": "BIGINT"})
