"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer numpy network.

Fitting takes a sample of at most SAMPLE_DOCS labelled documents, thinned by a hash of the id. Every word has a sparse
random index vector, fixed by its hash. A word's context vector is the sum of the index vectors of the words beside it
over the sample, kept in BUCKETS hashed rows. A document pools, over its words, index vectors of words and of their
shapes, context vectors, and repetition counts. A network of two layers is trained on the pooled vectors with Adam; a
part of the sample that it doesn't see fixes the temperature that calibrates its probabilities. Scores of all texts
come from one pass over whole texts.

Defined results: null and empty texts pool to the zero vector and get the score of that; null doc_id is never learned
from and not held out; rows without a label are scored only; if the sample holds one label only, every score is that
label's smoothed share; repeated rows each get a row; labels that occur several times for a doc_id count as their
largest; other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, documents, lean, mix64, tune, utf8, written

SAMPLE_DOCS = 6000
#: Tasks that sum the sample up.
SAMPLE_TASKS = 16
DIM, NONZERO, BUCKETS = 48, 4, 1 << 13
HIDDEN, EPOCHS, RATE, SEED = 48, 120, 0.004, 7
THRESHOLD = 0.7


def held_out(part: int = 2, of: int = 4):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == part, F.lit(False))


class Words:
    """The words of a batch of texts as arrays: their document, hash, shape's hash and length."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        n = len(raw)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        begin = ~space
        begin[1:] &= space[:-1]
        first = at[:-1][(at[:-1] < n) & (np.diff(at) > 0)]
        begin[first] = ~space[first]
        self.start = np.flatnonzero(begin)
        self.doc = np.searchsorted(at, self.start, "right") - 1
        m = len(self.start)
        if not m:
            self.hash = self.shape = np.zeros(0, np.uint64)
            self.size = np.zeros(0, np.int64)
            self.again = np.zeros(0, bool)
            return
        word = np.cumsum(begin) - 1
        inside = ~space
        w = word[inside]
        x = raw[inside].astype(np.uint64)
        nth = np.arange(n)[inside] - self.start[w]
        self.size = np.bincount(w, minlength=m)
        place = _POWERS[np.minimum(nth, len(_POWERS) - 1)]
        low = np.where((x >= 65) & (x <= 90), x + np.uint64(32), x)
        self.hash = mix64(np.add.reduceat(mix64(low + np.uint64(1)) * place, np.r_[0, np.cumsum(self.size)[:-1]]))
        kind = _KIND[raw[inside]]
        # A shape is the set of kinds of bytes in a word, the kind it begins and ends with, and its length in steps.
        ends = np.cumsum(self.size) - 1
        seen = np.bitwise_or.reduceat(np.uint64(1) << kind.astype(np.uint64), np.r_[0, ends[:-1] + 1])
        step = np.minimum(np.floor(np.log2(self.size + 1)), 6).astype(np.uint64)
        self.shape = mix64(((seen << np.uint64(16)) | (kind[np.r_[0, ends[:-1] + 1]].astype(np.uint64) << np.uint64(8)) | (kind[ends].astype(np.uint64) << np.uint64(4)) | step) + np.uint64(99))
        self.again = np.zeros(m, bool)
        self.again[1:] = (self.hash[1:] == self.hash[:-1]) & (self.doc[1:] == self.doc[:-1])


_POWERS = mix64(np.arange(1, 257, dtype=np.uint64))
_KIND = np.full(256, 5, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 stop or comma, 4 other ASCII, 5 beyond ASCII
_KIND[:128] = 4
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[[44, 46]] = 3


def index_sum(hashes: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """The sum of the sparse index vectors of words, by owner: each word adds +1 or -1 in NONZERO places."""
    out = np.zeros(owners * DIM)
    for k in range(NONZERO):
        h = mix64(hashes + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64))
        sign = np.where(h >> np.uint64(63), 1.0, -1.0)
        out += np.bincount(owner * DIM + (h % np.uint64(DIM)).astype(np.int64), sign, owners * DIM)
    return out.reshape(owners, DIM)


def contexts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What the words of these texts add to the context vectors, by bucket of the word."""
    w = Words(raw, at)
    out = np.zeros((BUCKETS, DIM))
    bucket = (w.hash % np.uint64(BUCKETS)).astype(np.int64)
    for step in (1, 2):
        same = w.doc[step:] == w.doc[:-step]
        out += index_sum(w.hash[step:][same], bucket[:-step][same], BUCKETS)
        out += index_sum(w.hash[:-step][same], bucket[step:][same], BUCKETS)
    return out


def pooled(raw: np.ndarray, at: np.ndarray, context: np.ndarray) -> np.ndarray:
    """One vector per text."""
    w, docs = Words(raw, at), len(at) - 1
    n = np.bincount(w.doc, minlength=docs).astype(float)
    per = 1.0 / np.maximum(n, 1)[:, None]
    words = index_sum(w.hash, w.doc, docs) * per
    shapes = index_sum(w.shape, w.doc, docs) * per
    # Context vectors: counts of the buckets met in each document, then one sparse-dense product by sorted keys.
    key, count = np.unique(w.doc * BUCKETS + (w.hash % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    meaning = np.zeros((docs, DIM))
    for a in range(0, len(key), 1 << 16):
        k, c = key[a : a + (1 << 16)], count[a : a + (1 << 16)]
        owner = k // BUCKETS
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        meaning[owner[first]] += np.add.reduceat(context[k % BUCKETS] * c[:, None], first)
    meaning *= per
    distinct = np.bincount(key // BUCKETS, minlength=docs)
    top = np.zeros(docs)
    np.maximum.at(top, key // BUCKETS, count)
    again = np.bincount(w.doc, w.again, docs)
    size = np.bincount(w.doc, w.size, docs)
    spread = np.bincount(w.doc, w.size.astype(float) ** 2, docs) * per[:, 0]
    mean = size * per[:, 0]
    kinds = np.zeros((docs, 6))
    of = np.repeat(np.arange(docs), np.diff(at))
    for k in range(6):
        kinds[:, k] = np.bincount(of, _KIND[raw] == k, docs) / np.maximum(np.diff(at), 1)
    plain = np.c_[np.log1p(n), distinct * per[:, 0], distinct / np.sqrt(np.maximum(n, 1)), top * per[:, 0], again * per[:, 0], mean / 10, np.sqrt(np.maximum(0, spread - mean**2)) / 10, kinds]
    return np.c_[words, shapes, meaning, plain]


class Network:
    """Standardized input, a hidden layer of rectified units, a logistic output, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.share = (y.sum() + 1) / (len(y) + 2)
        self.fitted = 0 < y.sum() < len(y)
        if not self.fitted:
            return
        rng = np.random.default_rng(SEED)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        x = np.clip((x - self.mean) / self.std, -8, 8)
        last = np.arange(len(x)) % 5 == 4  # not trained on: fixes the temperature
        if not 0 < y[last].sum() < last.sum():
            last[:] = False
        a, b = x[~last], y[~last]
        self.p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        m, v, t = [0.0 * q for q in self.p], [0.0 * q for q in self.p], 0
        for _ in range(EPOCHS if len(a) > 500 else 4 * EPOCHS):
            order = rng.permutation(len(a))
            for i in range(0, len(a), 256):
                xb, yb = a[order[i : i + 256]], b[order[i : i + 256]]
                h = np.maximum(0, xb @ self.p[0] + self.p[1])
                drop = (rng.random(h.shape) < 0.8) / 0.8
                hd = h * drop
                err = (1 / (1 + np.exp(-np.clip(hd @ self.p[2] + self.p[3], -30, 30))) - yb) / len(yb)
                gh = np.outer(err, self.p[2]) * drop * (h > 0)
                grads = [xb.T @ gh + 1e-3 * self.p[0] / 10, gh.sum(0), hd.T @ err + 1e-3 * self.p[2] / 10, err.sum(keepdims=True)]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.temperature = 1.0
        if last.any():
            z, yl = self._logit(x[last]), y[last]
            loss = lambda c: np.logaddexp(0, np.where(yl > 0.5, -z / c, z / c)).mean()
            self.temperature = float(min(np.geomspace(0.25, 8, 80), key=loss))

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(0, x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.share)
        z = self._logit(np.clip((x - self.mean) / self.std, -8, 8)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", most: int = SAMPLE_DOCS) -> tuple[np.ndarray, Network]:
    """The context vectors and the network, from documents and labels (doc_id, target)."""
    tune(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(target).alias("y"))
    n = known.count()
    h = F.xxhash64("doc_id")
    # About `most` rows by hash; the limit only holds where hashes fall unevenly.
    known = known.where(F.pmod(h, F.lit(max(1, n))) < most).orderBy(h, "doc_id").limit(most)
    # The sample is bounded, so it is dealt to a few tasks, each of which gives one table of sums, whatever the input's partitions.
    sample = written(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").repartition(SAMPLE_TASKS, "doc_id"), "sample")

    def count(batches):
        import pyarrow as pa

        total = np.zeros((BUCKETS, DIM))
        for batch in chunks(batches, 1 << 20):
            total += contexts(*utf8(batch.column(1)))
        # By slices, so that the sums of all partitions meet in several tasks.
        for i, part in enumerate(np.split(total.astype(np.int32), 8)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counts"])

    def add(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(data, np.int32).astype(np.int64)
                sums[i] = sums[i] + part if i in sums else part
        for i, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counts"])

    counted = sample.mapInArrow(lean(count), "slice int, counts binary").repartition(8, "slice").mapInArrow(lean(add), "slice int, counts binary").collect()
    context = np.zeros((8, BUCKETS // 8 * DIM))
    for r in counted:
        context[r.slice] += np.frombuffer(r.counts, np.int64)
    context = context.reshape(BUCKETS, DIM)
    context /= np.linalg.norm(context, axis=1, keepdims=True) + 1e-9

    def features(batches):
        import pyarrow as pa

        for batch in chunks(batches, 1 << 20):
            x = pooled(*utf8(batch.column(1)), context).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "y", "x"])

    rows = sample.select("doc_id", "text", F.col("y").cast("double").alias("y")).mapInArrow(lean(features), "doc_id long, y double, x binary").collect()
    rows.sort(key=lambda r: (hash((r.doc_id * 2654435761) & 0xFFFFFFFF), r.doc_id, bytes(r.x)))
    if not rows:
        return context, Network(np.zeros((0, 1)), np.zeros(0))
    return context, Network(np.stack([np.frombuffer(r.x, "<f4") for r in rows]).astype(float), np.asarray([r.y for r in rows]))


def score(docs: DataFrame, model: tuple[np.ndarray, Network], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and score, for every whole text."""
    spark = docs.sparkSession
    tune(spark)
    # The model's size is fixed by BUCKETS, DIM and HIDDEN: about 3 MB.
    shared = spark.sparkContext.broadcast(pickle.dumps(model))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", score double"

    def run(batches):
        import pyarrow as pa

        context, net = pickle.loads(shared.value)
        for batch in chunks(batches, 1 << 20, "__text"):
            x = pooled(*utf8(batch.column(batch.num_columns - 1)), context)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(net.score(x))], names=[*keep, "score"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(lean(run), fields)


def op7_quality_score(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
