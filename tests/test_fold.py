"""The fold against a plain Python one, over random operations."""

import random

from changelake.operators import fold


class Refused(Exception):
    pass


def plain_fold(held, ops, truncated, keys=("id",)):
    """held: row or None; ops: (txn, kind, before, row) in order; truncated gets how many rows of the group each truncate met."""
    live = [("start", held)] if held is not None else []
    concrete = lambda: [e for e in live if e[0] == "row"]
    last = None

    def target(before):
        if len(live) < 2:
            return len(live) - 1
        telling = {k: v for k, v in (before or {}).items() if k not in keys}
        if not telling:
            if len(concrete()) <= 1:
                return -1
            raise Refused
        hits = []
        for i, (kind, row) in enumerate(live):
            known = {k: v for k, v in telling.items() if kind == "row" or k in row}
            if known and all(row.get(k) == v for k, v in known.items()):
                hits.append((kind != "start", i))
        if not hits:
            raise Refused
        return min(hits)[1]

    for txn, kind, before, row in ops:
        if last is not None and txn != last and len(concrete()) > 1:
            raise Refused
        last = txn
        if kind == "truncate":
            truncated.append(len(concrete()))
            live = []
        elif kind == "place":
            live.append(("row", row))
        else:
            at = target(before)
            if kind == "update":
                live = [("row", row)] if at < 0 else [*live[:at], ("row", row), *live[at + 1 :]]
            else:
                live = [] if at < 0 else [*live[:at], *live[at + 1 :]]
    if len(concrete()) > 1:
        raise Refused
    if concrete():
        return "upsert", concrete()[-1][1]
    return ("keep", None) if live else ("delete", None)


def test_random_operations(spark):
    rng = random.Random(3)
    cases, ops, held = [], [], []
    for case in range(400):
        start = {"id": "k", "v": rng.choice("ab")} if rng.random() < 0.6 else None
        steps = []
        for seq in range(rng.randint(1, 7)):
            kind = rng.choice(["place", "update", "remove", "remove", "truncate"] if rng.random() < 0.2 else ["place", "update", "remove"])
            before = rng.choice([None, {"id": "k"}, {"id": "k", "v": rng.choice("abc")}, {"id": "k", "v": "__debezium_unavailable_value"}])
            row = {"id": "k", "v": rng.choice("abc")}
            steps.append((seq // 3, kind, before if kind != "place" else None, row if kind in ("place", "update") else None))
        cases.append((start, steps))
        op = {"place": "c", "update": "u", "remove": "d", "truncate": "t"}
        ops += [(str(case), None if kind == "truncate" else "k", None, seq, txn, op[kind], before, row) for seq, (txn, kind, before, row) in enumerate(steps)]
        if start:
            held.append((str(case), "k", start))
    df = spark.createDataFrame(ops, f"target string, key string, old_key string, seq long, txn long, op string, before {fold.ROW}, row {fold.ROW}")
    folded = fold.physical_fold(fold.key_operations(df, parts=3), spark.createDataFrame(held, f"target string, key string, row {fold.ROW}"), ["id"])
    out = {r.target: r for r in folded.collect()}
    removed = {}
    for r in fold.rows_removed(folded, fold.cuts(df), spark.createDataFrame(held, f"target string, key string, row {fold.ROW}").groupBy("target").count().withColumnRenamed("count", "rows")).collect():
        removed.setdefault(r.target, {})[r.epoch] = r.rows_removed
    refused = 0
    for case, (start, steps) in enumerate(cases):
        if all(kind == "truncate" for _, kind, _, _ in steps):
            assert str(case) not in out
            continue
        clean = [(t, k, {a: b for a, b in (p or {}).items() if b != "__debezium_unavailable_value"}, r) for t, k, p, r in steps]
        try:
            truncated = []
            want = plain_fold(start, clean, truncated)
        except Refused:
            refused += 1
            assert out[str(case)].ambiguous, (start, steps)
            continue
        got = out[str(case)]
        assert got.ambiguous is None, (start, steps)
        assert (got.action, got.row if got.action == "upsert" else None) == want, (start, steps)
        assert removed.get(str(case), {}) == {k: n + (k == 0 and start is not None) for k, n in enumerate(truncated)}, (start, steps)
    assert 20 < refused < 380
