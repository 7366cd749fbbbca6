"""Token-id files coded by a static range asymmetric numeral system (rANS).

Documents are dealt by ranges of doc_id; each range becomes segments of at most 2 * SEGMENT_IDS ids. A document of more than
SEGMENT_IDS ids is cut, and so is a segment with more than MOST_SYMBOLS different ids, until its table holds them: any
vocabulary and any length of text will do. A segment is one binary:

    header   magic, counts of parts, ids, symbols and blocks, crc32 of what follows
    table    the symbols (u32) and their frequencies (u32, sum 2**BITS), shared by all blocks of the segment
    parts    of documents, mostly whole ones: doc_id (i64), flags (u8: 1 doc_id is known, 2 the document ends here), number
             of ids (u32), ids of the document in earlier segments (u64) and their crc32 (u32)
    blocks   for each block of LANES * STEPS ids a checkpoint: first 16-bit word of its stream, crc32 of its ids, and the
             LANES states a decoder starts from; then all streams of 16-bit words

Blocks are independent: any can be decoded from its checkpoint and the table alone. A block interleaves LANES coders;
numpy steps all lanes of all blocks of a segment at once, in both directions. Segments are rows of a Parquet table in
the shared folder, written by Spark's committer, so that lost executors leave no half-written file.

Defined results: null and empty texts hold the end id only; null doc_id comes first; repeated rows are written as often
as they come, ordered by doc_id, then by a hash of the text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import chunks, documents, lean, sized, tune, utf8, written

BITS, LANES, STEPS = 16, 32, 256
SEGMENT_IDS, MOST_SYMBOLS = 1 << 19, 1 << 15
END_ID = 2
MAGIC = b"RANSSEG2"
HEAD = struct.Struct("<8s5I")
LOW = np.uint32(1 << 16)
HALF = np.uint32(16)


class Damaged(ValueError):
    """A checksum or a length of a segment is wrong."""


class Part(NamedTuple):
    """Ids (little-endian u32) of a document, with how many came before them and the crc32 of those."""

    doc_id: int | None
    ids: bytes
    before: int = 0
    crc: int = 0
    last: bool = True

    def cut(self, at: int) -> tuple[Part, Part]:
        """The first `at` ids, and the others."""
        head = self.ids[: 4 * at]
        return self._replace(ids=head, last=False), self._replace(ids=self.ids[4 * at :], before=self.before + at, crc=zlib.crc32(head, self.crc))


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts (at most MOST_SYMBOLS) scaled to the sum 2**BITS, each at least 1."""
    total = 1 << BITS
    freq = np.maximum(1, np.floor(counts * ((total - len(counts)) / counts.sum())).astype(np.int64))
    freq[np.argmax(freq)] += total - freq.sum()
    return freq


def encode_segments(parts: list[Part]) -> Iterator[tuple[int, bytes]]:
    """Segments of these parts, each with its number of ids: one, or the halves of it that hold fewer different ids."""
    flat = np.frombuffer(b"".join(p.ids for p in parts), "<u4")
    kinds = np.count_nonzero(np.bincount(flat)) if len(flat) and flat.max() < 1 << 22 else len(np.unique(flat))
    if kinds <= MOST_SYMBOLS:
        yield len(flat), encode_segment(parts)
        return
    half, ends = len(flat) // 2, np.cumsum([len(p.ids) // 4 for p in parts])
    k = int(np.searchsorted(ends, half))
    at = half - int(ends[k] - len(parts[k].ids) // 4)
    if at == len(parts[k].ids) // 4:
        first, second = parts[: k + 1], parts[k + 1 :]
    else:
        head, tail = parts[k].cut(at)
        first, second = [*parts[:k], head], [tail, *parts[k + 1 :]]
    yield from encode_segments(first)
    yield from encode_segments(second)


def encode_segment(parts: list[Part]) -> bytes:
    """One segment."""
    ids = [p.ids for p in parts]
    flat = np.frombuffer(b"".join(ids), "<u4")
    lengths = np.asarray([len(x) // 4 for x in ids], "<u4")
    if flat.max() < 1 << 22:  # a table by id, rather than sorting
        by_id = np.bincount(flat)
        symbols = np.flatnonzero(by_id)
        counts, place = by_id[symbols], np.zeros(len(by_id), np.int64)
        place[symbols] = np.arange(len(symbols))
        code = place[flat]
    else:
        symbols, code, counts = np.unique(flat, return_inverse=True, return_counts=True)
    freq = frequencies(counts)
    start = np.cumsum(freq) - freq
    per = LANES * STEPS
    blocks = -(-len(flat) // per)
    full = np.full(blocks * per, np.argmax(freq), np.int64)
    full[: len(flat)] = code
    grid = full.reshape(blocks, STEPS, LANES)
    f_all, c_all = freq.astype(np.uint32), start.astype(np.uint32)
    state = np.full((blocks, LANES), LOW, np.uint32)
    words = np.empty((STEPS, blocks, LANES), np.uint16)
    emitted = np.empty((STEPS, blocks, LANES), bool)
    for t in range(STEPS - 1, -1, -1):
        symbol = grid[:, t]
        f, c = f_all[symbol], c_all[symbol]
        high = state >> HALF
        over = high >= f
        words[t] = state  # its low 16 bits
        emitted[t] = over
        state = np.where(over, high, state)
        q = state // f
        state = (q << HALF) + (state - q * f) + c
    stream = words.transpose(1, 0, 2)[emitted.transpose(1, 0, 2)].astype("<u2")
    used = emitted.sum(axis=(0, 2))
    first = (np.cumsum(used) - used).astype("<u4")
    crcs = np.asarray([zlib.crc32(flat[b * per : (b + 1) * per].tobytes()) for b in range(blocks)], "<u4")
    flags = np.asarray([(p.doc_id is not None) + 2 * p.last for p in parts], np.uint8)
    names = np.asarray([p.doc_id or 0 for p in parts], "<i8")
    before, crc = np.asarray([p.before for p in parts], "<u8"), np.asarray([p.crc for p in parts], "<u4")
    body = b"".join(x.tobytes() for x in (symbols.astype("<u4"), freq.astype("<u4"), names, flags, lengths, before, crc, first, crcs, state.astype("<u4"), stream))
    return HEAD.pack(MAGIC, len(ids), len(flat), len(symbols), blocks, zlib.crc32(body)) + body


class Segment:
    """A segment's parts; decode() gives the ids of some blocks."""

    def __init__(self, data: bytes):
        magic, docs, n, symbols, self.blocks, crc = HEAD.unpack_from(data)
        if magic != MAGIC or zlib.crc32(memoryview(data)[HEAD.size :]) != crc:
            raise Damaged("not a segment, or damaged")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.n = n
        self.symbols, self.freq = take("<u4", symbols), take("<u4", symbols)
        names, flags, self.lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        self.doc_ids = [int(d) if f & 1 else None for d, f in zip(names, flags, strict=True)]
        self.last, self.before, self.crc = (flags & 2 > 0).tolist(), take("<u8", docs), take("<u4", docs)
        self.first, self.crcs = take("<u4", self.blocks), take("<u4", self.blocks)
        self.states = take("<u4", self.blocks * LANES).reshape(self.blocks, LANES)
        self.stream = take("<u2", (len(data) - at) // 2)

    def decode(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """The ids of blocks lo to hi, each checked against its checksum."""
        hi = self.blocks if hi is None else hi
        start = np.cumsum(self.freq) - self.freq
        slot = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq)
        by_slot = (np.arange(1 << BITS) - np.repeat(start, self.freq)).astype(np.uint32)
        f_slot = np.repeat(self.freq, self.freq).astype(np.uint32)
        state = self.states[lo:hi].astype(np.uint32)
        at = self.first[lo:hi].astype(np.int64)[:, None]
        stream = np.concatenate([self.stream, np.zeros(LANES, "<u2")]).astype(np.uint32)
        out = np.empty((hi - lo, STEPS, LANES), np.int32)
        for t in range(STEPS):
            low = state & np.uint32(0xFFFF)
            out[:, t] = slot[low]
            state = f_slot[low] * (state >> HALF) + by_slot[low]
            short = state < LOW
            nth = np.cumsum(short, axis=1)
            state = np.where(short, state << HALF | stream[np.minimum(at + nth - 1, len(stream) - 1)], state)
            at = at + nth[:, -1:]
        ids = self.symbols[out.reshape(hi - lo, -1)].astype("<u4")
        per = LANES * STEPS
        for b in range(lo, hi):
            if zlib.crc32(ids[b - lo, : min(per, self.n - b * per)].tobytes()) != self.crcs[b]:
                raise Damaged(f"block {b} is damaged")
        return ids.reshape(-1)[: self.n - lo * per if hi == self.blocks else None]


def write(docs: DataFrame, path: str | None = None, end_id: int = END_ID, out: str | None = None) -> DataFrame:
    """Writes the segments of all texts and returns the table of them: shard, segment, n_ids, data."""
    spark = docs.sparkSession
    tune(spark)
    path = path or tokens.default_path()
    spread = F.xxhash64("text")
    ranged = docs.select("doc_id", spread.alias("h"), F.col("text").alias("__text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc, last, k = tokens.encoder(path), np.asarray([end_id], "<u4").tobytes(), 0
        held, n = [], 0

        def done():
            nonlocal held, n, k
            for size, data in encode_segments(held):
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([k], pa.int32()), pa.array([size], pa.int64()), pa.array([data], pa.binary())], names=["shard", "segment", "n_ids", "data"])
                k += 1
            held, n = [], 0

        for batch in chunks(batches, 2 << 20, "__text"):
            raw, at = utf8(batch.column(2))
            raw, at = raw.tobytes(), at.tolist()
            for d, ids in zip(batch.column(0).to_pylist(), enc.encode([raw[a:b] for a, b in zip(at, at[1:], strict=False)]), strict=True):
                part = Part(d, ids + last)
                while part:
                    whole = len(part.ids) <= 4 * SEGMENT_IDS
                    head, part = (part, None) if whole else part.cut(SEGMENT_IDS)
                    held.append(head)
                    n += len(head.ids) // 4
                    if n >= SEGMENT_IDS:
                        yield from done()
        if held:
            yield from done()

    return written(ranged.mapInArrow(lean(run, keeps_words=True), "shard int, segment int, n_ids long, data binary"), "tokens", out)


def read(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of the files, decoded: doc_id, start, n_tokens and ids_crc32. With ids: every part of a document, mostly a
    whole one, with those columns as of the document up to the part's end, part_start (its place in the document) and ids."""
    tune(files.sparkSession)
    per_shard = files.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shards = per_shard.select("shard", (F.sum("shard_ids").over(upto) - F.col("shard_ids")).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = files.select("shard", "segment", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("before"))
    starts = starts.join(shards, "shard").select("shard", "segment", (F.col("before") + F.col("shard_start")).alias("first_id"))

    def run(batches):
        import pyarrow as pa

        kinds = (pa.int32(), pa.int32(), *(pa.int64(),) * 5, pa.binary())
        names = ["shard", "segment", "doc_id", "at", "n_tokens", "ids_crc32", "part_start", "ids"]
        for batch in batches:
            for shard, segment, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                s = Segment(data)
                ids = s.decode().tobytes()
                ends = np.cumsum(s.lengths.astype(np.int64))
                starts, before = (ends - s.lengths).tolist(), s.before.astype(np.int64).tolist()
                rows = []
                for i, (a, b) in enumerate(zip(starts, ends.tolist(), strict=True)):
                    if with_ids or s.last[i]:
                        part = ids[4 * a : 4 * b]
                        rows.append((shard, segment, s.doc_ids[i], a - before[i], before[i] + b - a, zlib.crc32(part, int(s.crc[i])), before[i], part if with_ids else None))
                for a in range(0, len(rows), 1000):
                    cols = zip(*rows[a : a + 1000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)], names=names)

    rows = files.select("shard", "segment", "data").mapInArrow(lean(run), "shard int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long, part_start long, ids binary")
    rows = rows.join(sized(starts, 32), ["shard", "segment"])
    return rows.select("doc_id", (F.col("first_id") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["part_start", "ids"] * with_ids)


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    return read(write(documents(spark, sf_dir)), with_ids=False)
