"""Removal of long byte strings that repeat in the corpus, through run-compressed Burrows-Wheeler indexes.

A window is a string of `least` bytes (400); every byte of a window that also starts anywhere else is removed.

1. Anchors. Among the GRAM-byte strings inside a window, the one with the smallest hash (the last of equals) is its
   anchor; equal windows have equal anchors at equal places, so they meet under the hash of the anchor. Neighbouring
   windows with the same anchor form one context: the bytes from the first window's start to the last one's end.
2. Anchors that occur once are dropped. Equal contexts are one, with a multiplicity; in a context that occurs twice all
   windows repeat. Contexts that share their anchor but differ (a passage's ends) are fetched, once each.
3. Those are indexed in units of bounded size: the suffixes of a unit's contexts are sorted, their Burrows-Wheeler
   transform is kept as runs with the sampled suffix at each run's head. The longest match of a suffix with its
   predecessor is computed at the heads only; inside a run it is one less than at the byte before, so matching
   statistics stream along the text. Windows whose longest match reaches `least` repeat.
4. A family of contexts too large for a unit is cut into PARTS by the place of the anchor in the window: each part knows
   more common bytes, which become the key, and has only its own windows' bytes. Where these are equal in several contexts
   all their windows repeat, and one copy goes on for the others to match: of a passage in many texts only the parts at
   its ends are cut further, so rows grow with the contexts, not with their windows too.
5. Repeating windows are joined back to all places of their context, merged per text, and cut out of the bytes.

Defined results: null text is empty; texts shorter than `least` lose nothing; matches never cross documents; copies of a
text of at least `least` bytes vanish all; repeated rows count as documents of their own; an empty table gives no rows;
null doc_id and other columns don't matter. Texts are matched by a 64-bit hash and their length.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BESIDE_TEXTS, chunks, documents, lean, mix64, sized, tune, utf8, written

LEAST = 400
BATCH_BYTES, PIECE = 1 << 19, 8 << 20
#: A unit of the index, in bytes; a family of contexts beyond FAMILY_BYTES is cut into PARTS.
UNIT_BYTES, FAMILY_BYTES, PARTS = 1 << 19, 3 << 18, 4
PLACE_BITS = np.uint64(26)
_BASE = 0x9E3779B97F4A7C15 | 5
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_powers: dict[str, np.ndarray] = {}


def gram_size(least: int) -> int:
    return max(1, least // 2)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0 to n, and their inverses, modulo 2**64."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(n + 1, 5 << 17)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(size, np.uint64(base))
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


def anchors(raw: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """For each context of these texts: text, first and last window start in it, anchor's place after the first start,
    hash of the anchor, hash of the context."""
    g, n = gram_size(least), len(raw)
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if n < least:
        return none
    up, down = powers(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=prefix[1:])
    gram = mix64((prefix[g:] - prefix[: n + 1 - g]) * down[: n + 1 - g])
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    key = (gram & ~mask) | (mask - np.arange(len(gram), dtype=np.uint64))
    w = least - g + 1
    starts = n - least + 1
    rows = -(-len(key) // w)
    padded = np.full(rows * w, ~np.uint64(0))
    padded[: len(key)] = key
    grid = padded.reshape(rows, w)
    upto = np.minimum.accumulate(grid, axis=1).ravel()
    onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    smallest = np.minimum(onward[:starts], upto[w - 1 : w - 1 + starts])
    place = (mask - (smallest & mask)).astype(np.int64)
    ends = np.repeat(at[1:], np.diff(at))[:starts]
    valid = np.arange(starts) + least <= ends
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    s0 = np.flatnonzero(begin)
    if not len(s0):
        return none
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    s1 = np.flatnonzero(stop)
    text = np.searchsorted(at, s0, "right") - 1
    off = place[s0] - s0
    length = (s1 - s0 + least).astype(np.uint64)
    context = mix64((prefix[s1 + least] - prefix[s0]) * down[s0] + mix64(length * np.uint64(1 << 20) + off.astype(np.uint64)))
    return text, s0 - at[text], s1 - at[text], off, mix64(gram[place[s0]] + np.uint64(77)).view(np.int64), context.view(np.int64)


class RunIndex:
    """The run-compressed Burrows-Wheeler transform of some strings, with the suffix sampled at each run's head."""

    def __init__(self, strings: list[bytes]):
        flat = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.asarray([len(s) for s in strings])
        n = len(flat)
        self.n, self.flat, self.sizes = n, flat, sizes
        end = np.repeat(np.cumsum(sizes), sizes)
        self.left = end - np.arange(n)  # bytes up to the string's end
        # Ranks of the first 7 bytes, then of twice as many with each round; a string's end sorts before any byte.
        symbol = np.zeros(n + 7, np.int64)
        symbol[:n] = flat.astype(np.int64) + 1
        packed = np.zeros(n, np.int64)
        for k in range(7):
            packed = packed << 9 | np.where(self.left > k, symbol[k : n + k], 0)
        rank = self._dense(packed)
        self.levels, k = [(7, rank.astype(np.int32))], 7
        longest = int(sizes.max(initial=0))
        while k < longest:
            after = np.zeros(n, np.int64)
            inside = np.flatnonzero(self.left > k)
            after[inside] = rank[inside + k] + 1
            rank = self._dense(rank.astype(np.int64) * (n + 1) + after)
            k *= 2
            self.levels.append((k, rank.astype(np.int32)))
            if int(rank.max(initial=0)) == n - 1:
                break
        # Equal suffixes keep the order of their strings, as if each string ended with a sign of its own.
        self.suffix = np.argsort(rank, kind="stable")
        before = np.where(self.suffix > 0, flat[self.suffix - 1].astype(np.int16), -1)
        starts = np.zeros(n, bool)
        starts[np.cumsum(sizes) - sizes] = True
        before[starts[self.suffix]] = -1
        # Runs of the transform: their heads, their byte (-1: a string's start) and the suffix at each head.
        self.head = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (before[1:] < 0)]) if n else np.zeros(0, np.int64)
        self.byte, self.sample = before[self.head], self.suffix[self.head]

    @staticmethod
    def _dense(values: np.ndarray) -> np.ndarray:
        order = np.argsort(values, kind="stable")
        ordered = values[order]
        rank = np.empty(len(values), np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]]) if len(values) else 0
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefixes of pairs of suffixes: by the ranks of each level, then byte by byte."""
        got, most = np.zeros(len(a), np.int64), np.minimum(self.left[a], self.left[b])
        for k, rank in [*reversed(self.levels), *[(1, self.flat)] * 6]:
            fits = got + k <= most
            x, y = np.where(fits, a + got, 0), np.where(fits, b + got, 0)
            got += np.where(fits & (rank[x] == rank[y]), k, 0)
        return got

    def matches(self, least: int) -> np.ndarray:
        """Whether the `least` bytes at each place also start at another place."""
        n = self.n
        if n < 2:
            return np.zeros(n, bool)
        # At run heads: how much the suffix shares with its predecessor; the first suffix has none.
        longest = np.full(n, -1, np.int64)
        longest[self.sample[0]] = 0
        longest[self.sample[1:]] = self.common(self.sample[1:], self.suffix[self.head[1:] - 1])
        # Inside a run the match is one less than at the byte before: stream it along the text.
        known = np.maximum.accumulate(np.where(longest >= 0, np.arange(n), 0))
        stream = np.maximum(longest[known] - (np.arange(n) - known), 0)
        following = np.zeros(n, np.int64)
        following[self.suffix[:-1]] = stream[self.suffix[1:]]
        return np.maximum(stream, following) >= least


def windows_of(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string, the starts of its windows that start anywhere else in the strings, too."""
    index = RunIndex(strings)
    hit = index.matches(least)
    at = np.r_[0, np.cumsum(index.sizes)]
    return [np.flatnonzero(hit[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def spans(starts: np.ndarray, least: int) -> bytes:
    """The maximal spans that windows at these ascending starts cover, as pairs of little-endian i32."""
    if not len(starts):
        return b""
    new = np.flatnonzero(np.r_[True, np.diff(starts) > least])
    last = np.r_[new[1:] - 1, len(starts) - 1]
    return np.c_[starts[new], starts[last] + least].astype("<i4").tobytes()


def merged(pairs: np.ndarray) -> np.ndarray:
    """The union of spans (n, 2), touching ones joined."""
    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.r_[True, pairs[1:, 0] > reach[:-1]]
    return np.c_[pairs[new, 0], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(pairs) - 1]]]


def keyed(docs: DataFrame, *more) -> DataFrame:
    """The text with its key: a hash and its length."""
    return docs.select(*more, F.xxhash64("text").alias("tkey"), F.octet_length("text").alias("tlen"), "text")


def places(docs: DataFrame, least: int) -> DataFrame:
    """Every context's place: gram, ctx, tkey, tlen, s0, s1, off."""

    def run(batches):
        import pyarrow as pa

        names = ["gram", "ctx", "tkey", "tlen", "s0", "s1", "off"]
        for batch in chunks(batches, BATCH_BYTES):
            raw, at = utf8(batch.column(2))
            tkey, tlen = batch.column(0), batch.column(1)
            parts = [(raw, at, 0)] if len(at) > 2 or len(raw) <= PIECE else [(raw[a : a + PIECE + least - 1], np.asarray([0, len(raw[a : a + PIECE + least - 1])]), a) for a in range(0, len(raw) - least + 1, PIECE)]
            for piece, ends, shift in parts:
                text, s0, s1, off, gram, ctx = anchors(piece, ends, least)
                index = pa.array(text)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(ctx), tkey.take(index), tlen.take(index), pa.array((s0 + shift).astype(np.int32)), pa.array((s1 + shift).astype(np.int32)), pa.array(off.astype(np.int32))], names=names)

    rows = keyed(docs).where(F.col("tlen") >= least)
    return rows.mapInArrow(lean(run), "gram long, ctx long, tkey long, tlen int, s0 int, s1 int, off int")


def contexts(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The bytes of contexts wanted (gram, ctx, tkey, tlen, s0, s1, off), each read from one text."""
    lists = wanted.groupBy("tkey", "tlen").agg(F.collect_list(F.struct("s0", "s1", "off", "gram", "ctx")).alias("cs"))
    lists = written(lists, "lists")
    texts = keyed(docs).where(F.col("tlen") >= least).join(sized(lists, 16, "cs", most=BESIDE_TEXTS), ["tkey", "tlen"]).select("tkey", "tlen", "cs", "text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, at = utf8(batch.column(3))
            out = []
            for i, cs in enumerate(batch.column(2).to_pylist()):
                data = raw[at[i] : at[i + 1]].tobytes()
                out += [(c["gram"], c["ctx"], c["off"], data[c["s0"] : c["s1"] + least]) for c in cs]
            for a in range(0, len(out), 2000):
                g, c, o, d = zip(*out[a : a + 2000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(c, pa.int64()), pa.array(o, pa.int32()), pa.array(d, pa.binary())], names=["gram", "ctx", "off", "data"])

    # Copies of a text give the same contexts again: one of each stays.
    return texts.mapInArrow(lean(run), "gram long, ctx long, off int, data binary").dropDuplicates(["gram", "ctx"])


def indexed(families: DataFrame, least: int) -> DataFrame:
    """gram, ctx, spans of what repeats within families (key, gram, ctx, at, data), by run indexes of whole families."""

    def run(batches):
        import pyarrow as pa

        # By context and the place of its bytes: parts of a context have no window in common, so none matches itself.
        held: dict[tuple[int, int, int], bytes] = {}
        size, key, family, family_size = 0, None, {}, 0

        def done():
            found = windows_of(list(held.values()), least)
            rows = [(g, c, spans(s + at, least)) for (g, c, at), s in zip(held, found, strict=True) if len(s)]
            if rows:
                g, c, s = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.binary())], names=["gram", "ctx", "spans"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != key:
                    if held and size + family_size > UNIT_BYTES:
                        yield from done()
                        held.clear()
                        size = 0
                    held.update(family)
                    size += family_size
                    key, family, family_size = row[0], {}, 0
                family[row[1], row[2], row[3]] = row[4]
                family_size += len(row[4])
        if held and size + family_size > UNIT_BYTES:
            yield from done()
            held.clear()
        held.update(family)
        if held:
            yield from done()

    placed = families.select("key", "gram", "ctx", "at", "data").repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(lean(run), "gram long, ctx long, spans binary")


def parted(families: DataFrame, least: int) -> DataFrame:
    """Contexts of families, under keys that hold more of the window: once for each of PARTS of the places lo to hi that
    their anchors may have in a window, with the bytes of these windows alone, which start at `at` in the context, and
    their hash (same)."""
    fields = ["key", "same", "gram", "ctx", "off", "at", "data", "lo", "hi"]

    def run(batches):
        import pyarrow as pa

        def number(data, a, b):
            return int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=b"%d.%d" % (a, b)).digest(), "little", signed=True)

        for batch in batches:
            out = []
            for gram, ctx, off, at, data, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                step = -(-(hi - lo + 1) // PARTS)
                windows = len(data) - least  # places of the anchor: off - windows to off
                for a in range(lo, hi + 1, step):
                    b = min(a + step - 1, hi)
                    first, last = min(b, off), max(a, off - windows)  # places in the part's first and last window
                    if last <= first:
                        common, own = data[off - a : off - b + least], data[off - first : off - last + least]
                        out.append((number(common, a, b), number(own, a, b), gram, ctx, first, at + off - first, own, a, b))
            for i in range(0, len(out), 2000):
                cols = list(zip(*out[i : i + 2000], strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=fields)

    rows = families.select("gram", "ctx", "off", "at", "data", "lo", "hi").mapInArrow(lean(run), "key long, same long, gram long, ctx long, off int, at int, data binary, lo int, hi int")
    return written(rows, "parts")


def repeated(found: DataFrame, least: int) -> DataFrame:
    """gram, ctx, spans for contexts (gram, ctx, off, data) with windows that repeat in other contexts."""
    g = gram_size(least)
    families = written(found.select(F.col("gram").alias("key"), "gram", "ctx", "off", F.lit(0).alias("at"), "data", F.lit(0).alias("lo"), F.lit(least - g).alias("hi")), "families")
    out = None
    while True:
        sizes = families.groupBy("key").agg(F.count("*").alias("m"), F.sum(F.octet_length("data")).alias("total")).where("m > 1")
        sizes = written(sizes, "sizes")
        small = indexed(families.join(sized(sizes.where(F.col("total") <= FAMILY_BYTES), 32), "key"), least)
        out = small if out is None else out.unionByName(small)
        large = sizes.where(F.col("total") > FAMILY_BYTES).select("key")
        if large.isEmpty():
            return out
        # Parts of one window that share their key are equal, so nothing is left to cut of them.
        parts = parted(families.join(sized(large, 16), "key").where("lo < hi"), least)
        often = written(parts.groupBy("key", "same").agg(F.count("*").alias("c")).where("c > 1").select("key", "same"), "often")
        # Every window of equal parts repeats.
        whole = parts.join(sized(often, 24), ["key", "same"]).select("gram", "ctx", "at", (F.col("at") + F.octet_length("data")).alias("end"))

        def fixed(batches):
            import pyarrow as pa

            for batch in batches:
                pairs = np.c_[np.asarray(batch.column(2)), np.asarray(batch.column(3))].astype("<i4")
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in pairs], pa.binary())], names=["gram", "ctx", "spans"])

        out = out.unionByName(whole.mapInArrow(lean(fixed), "gram long, ctx long, spans binary"))
        families = written(parts.dropDuplicates(["key", "same"]).drop("same"), "families")


def covers(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """tkey, tlen, spans (merged pairs of i32) of every text that holds repeating windows."""
    tune(docs.sparkSession)
    every = written(places(docs, least), "places")
    often = written(every.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"), "grams")
    some = written(every.join(sized(often, 16), "gram", "left_semi"), "shared")
    per = some.groupBy("gram", "ctx").agg(F.count("*").alias("c"), F.min(F.struct("tkey", "tlen", "s0", "s1", "off")).alias("at"))
    per = written(per.select("gram", "ctx", "c", "at.*"), "contexts")
    mixed = written(per.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1").select("gram"), "mixed")
    wanted = per.join(sized(mixed, 16), "gram", "left_semi")
    partial = repeated(contexts(docs, wanted, least), least)
    twice = per.where("c > 1").select("gram", "ctx", F.lit(None).cast("binary").alias("spans"))
    once = partial.join(per.where("c = 1").select("gram", "ctx"), ["gram", "ctx"])
    verdict = written(twice.unionByName(once), "verdicts")
    hits = some.join(sized(verdict, 24, "spans"), ["gram", "ctx"]).select("tkey", "tlen", "s0", F.when(F.col("spans").isNull(), F.col("s1") + least).alias("end"), "spans").distinct()

    def join_up(batches):
        import pyarrow as pa

        key, held = None, []

        def one():
            return key[0], key[1], merged(np.concatenate(held)).astype("<i4").tobytes()

        def out_of(rows):
            t, n, s = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(n, pa.int32()), pa.array(s, pa.binary())], names=["tkey", "tlen", "spans"])

        rows = []
        for batch in batches:
            for tkey, tlen, s0, end, sp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tkey, tlen) != key:
                    if held:
                        rows.append(one())
                    if len(rows) >= 1000:
                        yield out_of(rows)
                        rows = []
                    key, held = (tkey, tlen), []
                held.append(np.asarray([[s0, end]]) if sp is None else np.frombuffer(sp, "<i4").reshape(-1, 2) + s0)
                if len(held) > 1000:
                    held = [merged(np.concatenate(held))]
        if held:
            rows.append(one())
        if rows:
            yield out_of(rows)

    placed = hits.repartition("tkey", "tlen").sortWithinPartitions("tkey", "tlen")
    return written(placed.mapInArrow(lean(join_up), "tkey long, tlen int, spans binary"), "covers")


def whole_characters(data: bytes, pairs: list[list[int]]) -> list[list[int]]:
    """Spans widened to whole characters, so that what stays is UTF-8."""
    out: list[list[int]] = []
    for a, b in pairs:
        while a and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return out


def cut(docs: DataFrame, least: int = LEAST, keep: tuple[str, ...] = ("doc_id",), characters: bool = False) -> DataFrame:
    """keep, n_bytes, n_removed, n_spans and kept (the bytes that stay; whole characters, if so wanted) of every document."""
    found = covers(docs, least)
    texts = keyed(docs, *[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)])
    rows = texts.join(sized(found, 16, "spans", most=BESIDE_TEXTS), ["tkey", "tlen"], "left").select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], F.col("spans").alias("__spans"), F.col("text").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", n_bytes long, n_removed long, n_spans long, kept binary"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, at = utf8(batch.column(batch.num_columns - 1))
            cols: tuple[list, ...] = ([], [], [], [])
            for i, sp in enumerate(batch.column(batch.num_columns - 2).to_pylist()):
                data = raw[at[i] : at[i + 1]].tobytes()
                pairs = np.frombuffer(sp, "<i4").reshape(-1, 2).tolist() if sp else []
                pairs = whole_characters(data, pairs) if characters else pairs
                kept = data if not pairs else b"".join(data[a:b] for a, b in zip([0, *(p[1] for p in pairs)], [*(p[0] for p in pairs), len(data)], strict=True))
                for c, v in zip(cols, (len(data), len(data) - len(kept), len(pairs), kept), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=[*keep, "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(lean(run), fields)


def op6_repeated_spans(spark, sf_dir: str) -> DataFrame:
    """Beside the digests: n_kept, and text, the kept bytes as text (a character that a span cuts through is replaced)."""
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")]
    return cut(documents(spark, sf_dir)).select(*columns, F.octet_length("kept").cast("long").alias("n_kept"), F.make_valid_utf8("kept").alias("text"))
