"""Connected components against a plain union of sets, and how a hub's edges are dealt."""

import random

import pytest

from changelake.llm import graphs


def brute(edges):
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = of(a), of(b)
            root[max(x, y)] = min(x, y)
    return sorted((x, of(x)) for x in root)


@pytest.mark.parametrize("edges", [
    [(1, 1)],
    [(i, i + 1) for i in range(40)],
    [(500, i) for i in range(60)] + [(i, 500) for i in range(60)] + [(900, 901), (901, 901), (902, 900)],
    [(random.Random(i).randrange(90), random.Random(-i - 1).randrange(90)) for i in range(70)],
])
def test_components(spark, edges):
    found = graphs.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == brute(edges)


def test_components_of_nothing(spark):
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_is_split_over_tasks(spark, monkeypatch):
    held = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in held}
    plans, write = [], graphs.written

    def seen(df, label, path=None):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label, path)

    monkeypatch.setattr(graphs, "written", seen)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = spark.range(1, 40_001, 1, 8).selectExpr("id AS a", "0L AS b")
        assert graphs.components(edges).where("root = 0").count() == 40_001
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("skew=true" in p for p in plans if "SortMergeJoin" in p)
