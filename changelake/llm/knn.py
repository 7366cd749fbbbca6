"""Exact top-k search by inner product: a Voronoi kNN join.

Components become floor(256 x). With M the largest norm of any vector, a data vector x gets one more component
sqrt(M^2 - |x|^2) and a query q a 0; then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the largest inner products are the
nearest neighbours of a metric space. Queries and data are grouped by their nearest pivot. Summaries of the groups (the
radius of the queries, the k + 1 smallest distances of different vec_ids of the data to its pivot, so that repeated rows
don't count as neighbours) bound how far the k-th neighbour of any query of a group can be; data vectors beyond that bound aren't sent to the group. A group's queries (in blocks of
QUERY_ROWS) meet its data in units of bounded size: a unit keeps its queries and streams its data, and partial lists of
k are merged by query. Scores are exact integers; bounds carry a slack for rounding and only ever send too much.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null vec_id, take no part;
missing components of shorter vectors count as 0; rows that bear the query's vec_id are its own; rows that
repeat both a vec_id and its score count once; equal scores go to the smaller vec_id; with fewer than k candidates all are returned; an empty table gives
no rows; a score beyond 64 bits is the largest or smallest long; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, tune

K, SCALE = 5, 256.0
#: Pivots: one for so many queries, within these limits; queries of a block; data rows of a unit.
QUERY_ROWS, LEAST_PIVOTS, MOST_PIVOTS = 1024, 4, 512
UNIT_ROWS = 1 << 16


def matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """(whether each row takes part, float64 matrix of floor(SCALE * x) of those that do)."""
    import pyarrow as pa

    n = len(column)
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_list(column.type) else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    flat = np.floor(np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)[at[0] : at[-1]] * SCALE)
    sizes = np.diff(at)
    bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
    rel = at - at[0]
    good = np.asarray(column.is_valid()) & (bad[rel[1:]] == bad[rel[:-1]])
    out = np.zeros((n, int(sizes[good].max()) if good.any() else 0))
    rows = np.repeat(np.arange(n), sizes)
    keep = good[rows]
    out[rows[keep], (np.arange(len(flat)) - np.repeat(rel[:-1], sizes))[keep]] = flat[keep]
    return good, out[good]


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as integers: in doubles where those hold them, else in Python's integers, cut to 64 bits."""
    if exact:
        return (q @ x.T).astype(np.int64)
    big = lambda m: np.asarray([[int(v) for v in row] for row in m], object).reshape(m.shape)
    return np.asarray([[max(-(2**63), min(2**63 - 1, int(v))) for v in row] for row in big(q) @ big(x).T], np.int64).reshape(len(q), len(x))


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k best (score, then id) of one query; ids are ascending."""
    i = int(np.searchsorted(ids, own))
    if i < len(ids) and ids[i] == own:
        mine = np.arange(i, int(np.searchsorted(ids, own, "right")))
        others = np.delete(np.arange(len(ids)), mine)
        return others[best(scores[others], ids[others], -(2**63), k)] if len(others) else others
    if len(scores) <= k:
        return np.argsort(-scores.astype(object), kind="stable") if len(scores) else np.zeros(0, np.int64)
    limit = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > limit)
    return np.r_[above, np.flatnonzero(scores == limit)[: k - len(above)]]


def nearest(d: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest distances of different ids, ascending, with their ids."""
    order = np.lexsort((ids, d))
    d, ids = d[order], ids[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return d[first], ids[first]


def distinct_pairs(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair (id, score) once, ids ascending."""
    order = np.lexsort((scores, ids))
    ids, scores = ids[order], scores[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])]
    return ids[new], scores[new]


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k best vectors for each row of vectors (vec_id, embedding) with is_query."""
    spark = vectors.sparkSession
    tune(spark)
    base = vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("is_query")).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def survey(batches):
        import pyarrow as pa

        n, queries, width = 0, 0, 0
        norm = most = 0.0
        for batch in batches:
            good, x = matrix(batch.column(1))
            if len(x):
                n, queries = n + len(x), queries + int(np.asarray(batch.column(2))[good].sum())
                width, most = max(width, x.shape[1]), max(most, float(np.abs(x).max(initial=0.0)))
                norm = max(norm, float((x * x).sum(1).max()))
        yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in (n, queries, width)), *(pa.array([v], pa.float64()) for v in (norm, most))], names=["n", "queries", "width", "norm", "most"])

    s = base.mapInArrow(lean(survey), "n long, queries long, width long, norm double, most double").agg(F.sum("n").alias("n"), F.sum("queries").alias("queries"), F.max("width").alias("width"), F.max("norm").alias("norm"), F.max("most").alias("most")).first()
    if not s.n or not s.queries:
        return empty
    exact = s.width * (s.most + 1) ** 2 < 2**53
    width, top = s.width, float(s.norm)
    n_pivots = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, -(-s.queries // QUERY_ROWS))))
    # A sample of bounded size: the pivots are the vectors with the smallest hashes of their ids.
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * n_pivots).select("embedding").toArrow()
    good, pivots = matrix(sample.column(0).combine_chunks() if sample.num_rows else sample.column(0))
    pivots = widened(pivots, width)[:n_pivots] if len(pivots) else np.zeros((1, width))
    pivots = np.unique(pivots, axis=0)
    p_extra = np.sqrt(np.maximum(0.0, top - (pivots * pivots).sum(1)))

    def to_pivots(x: np.ndarray) -> np.ndarray:
        """Distances of data vectors to the pivots."""
        extra = np.sqrt(np.maximum(0.0, top - (x * x).sum(1)))
        return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (extra * extra)[:, None] + top - 2 * (x @ pivots.T + np.outer(extra, p_extra))))

    def home(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pivot nearest to each query (by exact integers, the first of equals), and its distance."""
        dots = q @ pivots.T
        at = dots.argmax(1)
        return at, np.sqrt(np.maximum(0.0, (q * q).sum(1) + top - 2 * dots[np.arange(len(q)), at]))

    def summarize(batches):
        import pyarrow as pa

        radius, queries = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
        near = [(np.zeros(0), np.zeros(0, np.int64))] * len(pivots)
        for batch in batches:
            good, x = matrix(batch.column(1))
            x = widened(x, width)
            if not len(x):
                continue
            ids = np.asarray(batch.column(0))[good].astype(np.int64)
            d = to_pivots(x)
            cell = d.argmin(1)
            for j in np.unique(cell):
                mine = nearest(d[cell == j, j], ids[cell == j], k + 1)
                near[j] = nearest(np.r_[near[j][0], mine[0]], np.r_[near[j][1], mine[1]], k + 1)
            q = x[np.asarray(batch.column(2))[good]]
            if len(q):
                at, far = home(q)
                np.maximum.at(radius, at, far)
                np.add.at(queries, at, 1)
        # A row for each cell and near id; a cell's radius and count stand in its first one, which may be without an id.
        out = []
        for j in range(len(pivots)):
            pairs = list(zip(near[j][1].tolist(), near[j][0].tolist(), strict=True)) or [(None, None)]
            out += [(j, int(queries[j]) if not i else 0, float(radius[j]) if not i else -1.0, *pair) for i, pair in enumerate(pairs)]
        types = (pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["cell", "queries", "radius", "id", "d"])

    found = base.mapInArrow(lean(summarize), "cell int, queries long, radius double, id long, d double")
    found = found.groupBy("cell", "id").agg(F.sum("queries").alias("queries"), F.max("radius").alias("radius"), F.min("d").alias("d")).groupBy("cell")
    found = found.agg(F.sum("queries").alias("queries"), F.max("radius").alias("radius"), F.slice(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("d", "id")))), 1, k + 1).alias("near")).collect()
    radius, queries = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    near: list[list[tuple[float, int]]] = [[]] * len(pivots)
    for r in found:
        radius[r.cell], queries[r.cell], near[r.cell] = r.radius, r.queries, [(x.d, x.id) for x in r.near]
    cells, near_d, near_id = (np.array(c, t) for c, t in zip(zip(*((j, *x) for j, v in enumerate(near) for x in v), strict=True), (np.int64, np.float64, np.int64), strict=True))
    between = to_pivots(pivots)
    slack = 1e-6 * (1.0 + np.sqrt(top))
    reach = np.full(len(pivots), np.inf)
    for i in range(len(pivots)):
        upper = nearest(radius[i] + between[i, cells] + near_d, near_id, k + 1)[0]
        if exact and len(upper) > k:
            reach[i] = radius[i] + upper[k] + slack
    blocks = -(-queries // QUERY_ROWS)
    units = max(1, -(-s.n // UNIT_ROWS))
    # Without the usual parallelism of shuffles, small inputs still spread over a few units.
    units = max(units, min(8, -(-s.n // 4096)))

    def send(batches):
        """Rows (block of queries, unit, kind, ids, vectors): queries go to all units of their block, data to one."""
        import pyarrow as pa
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            good, x = matrix(batch.column(1))
            x = widened(x, width)
            if not len(x):
                continue
            ids = np.asarray(batch.column(0))[good].astype(np.int64)
            out = []
            wants = np.asarray(batch.column(2))[good]
            if wants.any():
                at, _ = home(x[wants])
                q_ids, q = ids[wants], x[wants]
                block = (q_ids * np.int64(0x9E3779B1) >> 7) % blocks[at]
                for i, b in np.unique(np.c_[at, block], axis=0):
                    mine = (at == i) & (block == b)
                    row = (q_ids[mine].astype("<i8").tobytes(), q[mine].astype("<f8").tobytes())
                    out += [(int(i), int(b), u, 0, *row) for u in range(units)]
            d = to_pivots(x)
            unit = (part * 7919 + nth) % units
            nth += 1
            for i in np.flatnonzero(queries > 0):
                mine = d[:, i] <= reach[i]
                if mine.any():
                    row = (ids[mine].astype("<i8").tobytes(), x[mine].astype("<f8").tobytes())
                    out += [(int(i), b, unit, 1, *row) for b in range(int(blocks[i]))]
            for a in range(0, len(out), 8):
                cols = list(zip(*out[a : a + 8], strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:4]), *(pa.array(c, pa.binary()) for c in cols[4:])], names=["cell", "block", "unit", "kind", "ids", "vectors"])

    def solve(batches):
        import pyarrow as pa

        key, q_ids, q, lists = None, None, None, None

        def answer():
            rows = [(int(i), int(v), int(w)) for i, (vs, ws) in zip(q_ids.tolist(), lists, strict=True) for v, w in zip(vs, ws, strict=True)]
            for a in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[a : a + 10_000], strict=True)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for cell, block, unit, kind, ids, vectors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (cell, block, unit) != key:
                    if lists:
                        yield from answer()
                    key, q_ids, q, lists = (cell, block, unit), np.zeros(0, np.int64), np.zeros((0, width)), []
                ids = np.frombuffer(ids, "<i8")
                vectors = np.frombuffer(vectors, "<f8").reshape(len(ids), width)
                if kind == 0:
                    q_ids, q = np.r_[q_ids, ids], np.r_[q, vectors]
                    lists += [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
                    continue
                rows = np.unique(np.c_[ids, vectors.view(np.int64)], axis=0)  # ascending ids, repeats once
                ids, vectors = rows[:, 0], np.ascontiguousarray(rows[:, 1:]).view(np.float64)
                several = bool((ids[1:] == ids[:-1]).any())
                for a in range(0, len(q), 256):
                    scores = products(q[a : a + 256], vectors, exact)
                    for i in range(len(scores)):
                        ids_i, scores_i = distinct_pairs(ids, scores[i]) if several else (ids, scores[i])
                        at = best(scores_i, ids_i, int(q_ids[a + i]), k)
                        vs, ws = np.r_[lists[a + i][0], ids_i[at]], np.r_[lists[a + i][1], scores_i[at]]
                        order = np.lexsort((vs, -ws))
                        vs, ws = vs[order], ws[order]
                        new = np.r_[True, (vs[1:] != vs[:-1]) | (ws[1:] != ws[:-1])] if len(vs) else np.zeros(0, bool)
                        lists[a + i] = (vs[new][:k], ws[new][:k])
        if lists:
            yield from answer()

    sent = base.mapInArrow(lean(send), "cell int, block int, unit int, kind int, ids binary, vectors binary")
    sent = sent.repartition("cell", "block", "unit").sortWithinPartitions("cell", "block", "unit", "kind")
    partial = sent.mapInArrow(lean(solve), "query_id long, vec_id long, score long").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_voronoi_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: COALESCE(p[1] * p[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
