"""Best-fit packing of tokenized documents into sequences, by bin completion over the histogram of piece lengths.

Lengths are at most CAP, so the problem to solve is a histogram of at most CAP numbers, whatever the corpus. Branch and
bound: each step takes the largest length left and branches over the undominated fillings of the room beside it, those
without waste first (one item of the same total dominates two), applied as often as the counts allow or once. Best-fit
decreasing gives the first incumbent, each better plan the next; a branch is cut once its waste, or the lower bound of what
it leaves, shows that it can't beat the incumbent. The plan is a list of patterns with multiplicities. Pieces then find their places by their rank
within their length; ranks are dealt in two levels (buckets of RANK_ROWS pieces), so that no length meets in one task.

Defined results: null and empty texts are one piece holding the end id only; repeated rows are packed as documents of
their own; an empty table gives no rows; other columns of the input are ignored; null doc_id stays null.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import chunks, documents, lean, sized, tune, utf8, written

CAP = 2048
END_ID = 0
RANK_ROWS = 2000
#: Words that a worker's encoder keeps.
CACHE_WORDS = 500_000
#: Steps of the search for a plan: fillings looked at, over all bins, and CHOICE_STEPS for each bin chosen; some 20 seconds at
#: most. Where they end before a plan reaches the lower bound or all others are excluded, the best one so far is used. Plans
#: of few lengths (EXACT_LENGTHS) use a tighter bound and remember what was left.
STEPS, CHOICE_STEPS, EXACT_LENGTHS = 2_000_000, 20, 64
PIECE = "piece int, start long, length long, ids_crc32 long"


def lower_bound(hist: dict[int, int], cap: int) -> int:
    """Martello and Toth's L2: for each threshold k, items over cap - k need bins of their own."""
    best = -(-sum(l * n for l, n in hist.items()) // cap)
    for k in [*{min(l, cap - l) for l in hist if 0 < min(l, cap - l) <= cap // 2}][:512]:
        big = sum(n for l, n in hist.items() if l > cap - k)
        mid = [(l, n) for l, n in hist.items() if cap // 2 < l <= cap - k]
        small = sum(l * n for l, n in hist.items() if k <= l <= cap // 2)
        free = sum((cap - l) * n for l, n in mid)
        best = max(best, big + sum(n for _, n in mid) + max(0, -(-(small - free) // cap)))
    return best


def best_fit_decreasing(hist: dict[int, int], cap: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: bins of the same content move together."""
    gaps: list[int] = []
    open_bins: dict[int, list[list]] = {}

    def put(items: tuple[int, ...], n: int) -> None:
        gap = cap - sum(items)
        if gap not in open_bins:
            gaps.insert(bisect_right(gaps, gap), gap)
        open_bins.setdefault(gap, []).append([items, n])

    for length in sorted(hist, reverse=True):
        n = hist[length]
        while n:
            at = bisect_right(gaps, length - 1)
            if at == len(gaps):
                each = cap // length
                if n >= each:
                    put((length,) * each, n // each)
                if n % each:
                    put((length,) * (n % each), 1)
                break
            gap = gaps[at]
            items, k = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap]
                gaps.pop(at)
            use = min(n, k)
            if k > use:
                put(items, k - use)
            put((*items, length), use)
            n -= use
    return [(items, n) for group in open_bins.values() for items, n in group]


class Spent(Exception):
    """The search has used up its steps."""


class Search:
    """Branch and bound over bins: depth first, with the best plan so far as incumbent."""

    def __init__(self, hist: dict[int, int], cap: int, incumbent: list, bound: int, steps: int):
        self.cap, self.bound, self.steps = cap, bound, steps
        self.left = {l: n for l, n in hist.items() if n}
        self.lengths = sorted(self.left, reverse=True)
        self.total = self.rest = sum(l * n for l, n in self.left.items())
        self.best, self.most = incumbent, sum(n for _, n in incumbent)
        self.exact = len(self.left) <= EXACT_LENGTHS
        self.seen: dict[tuple, int] = {}

    def fillings(self):
        """Bins for the largest length left, with undominated fillings beside it: at once if one leaves no waste, the others in
        order of their waste. Only maximal ones are given, and none that holds two items where one of their total exists; one
        item of the whole room dominates all."""
        left, lengths = self.left, self.lengths
        big, n = lengths[0], len(lengths)
        if left.get(self.cap - big, 0) > (self.cap == 2 * big):
            yield big, self.cap - big
            return
        keys = [-l for l in lengths]
        given: set[tuple[int, ...]] = set()
        others: list[tuple[int, tuple[int, ...]]] = []

        def go(at: int, room: int, items: tuple[int, ...]):
            self.steps -= 1
            if self.steps < 0:
                raise Spent
            fits = bisect_left(keys, -room, 0, n)
            if fits < n and lengths[fits] == room and left[room] > items.count(room):
                whole = (big, *sorted((*items[1:], room), reverse=True))
                if whole not in given:
                    given.add(whole)
                    yield whole
            if not any(left[l] > items.count(l) for l in reversed(lengths[fits:])):
                if room and items not in given:
                    given.add(items)
                    others.append((room, items))
                return
            for j in range(max(at, fits), n):
                l = lengths[j]
                if len(items) == 2 and left.get(items[1] + l, 0) > ((big == items[1] + l) + (l == items[1])):
                    continue
                for c in range(min(left[l] - (l == big), room // l), 0, -1):
                    if c == 2 and len(items) == 1 and left.get(2 * l, 0) > (2 * l == big):
                        continue
                    if c * l < room:
                        yield from go(j + 1, room - c * l, (*items, *(l,) * c))

        yield from go(0, self.cap - big, (big,))
        for _, items in sorted(others, key=lambda f: (f[0], len(f[1]))):
            yield items

    def options(self):
        """What may be done with the largest length left: a bin of it, as often as the counts allow, or once."""
        once = []
        for items in self.fillings():
            times = min(self.left[l] // items.count(l) for l in set(items))
            if times > 1:
                once.append(items)
            yield items, times
        for items in once:
            yield items, 1

    def change(self, items: tuple[int, ...], times: int) -> None:
        for l in set(items):
            n = self.left.get(l, 0) - items.count(l) * times
            if n:
                if l not in self.left:
                    insort(self.lengths, l, key=lambda x: -x)
                self.left[l] = n
            else:
                del self.left[l]
                self.lengths.remove(l)
        self.rest -= sum(items) * times

    def run(self) -> list[tuple[tuple[int, ...], int]]:
        plan: list[tuple[tuple[int, ...], int]] = []
        used, stack = 0, [self.options()] if self.left else []
        try:
            while stack and self.most > self.bound:
                if len(plan) == len(stack):
                    items, times = plan.pop()
                    self.change(items, -times)
                    used -= times
                choice = next(stack[-1], None)
                if choice is None:
                    stack.pop()
                    continue
                self.steps -= CHOICE_STEPS
                self.change(*choice)
                plan.append(choice)
                used += choice[1]
                # The waste of the bins so far leaves too little room for what remains to beat the incumbent.
                fewest = used + (lower_bound(self.left, self.cap) if self.exact else -(-self.rest // self.cap))
                known = self.exact and self.left and self.seen.get(state := tuple(sorted(self.left.items())), used + 1) <= used
                if fewest >= self.most or known:
                    stack.append(iter(()))
                elif not self.left:
                    self.best, self.most = list(plan), used
                    stack.append(iter(()))
                else:
                    if self.exact:
                        self.seen[state] = used
                    stack.append(self.options())
        except Spent:
            pass
        return self.best


def plan(hist: dict[int, int], cap: int = CAP, steps: int = STEPS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; every length of the histogram is used exactly as often as it occurs."""
    if not hist:
        return []
    return Search(hist, cap, best_fit_decreasing(hist, cap), lower_bound(hist, cap), steps).run()


def cut(docs: DataFrame, path: str | None = None, cap: int = CAP, end_id: int = END_ID, keep: tuple[str, ...] = ("doc_id",), cache_words: int = CACHE_WORDS) -> DataFrame:
    """The pieces of every document: keep, piece, start, length, ids_crc32."""
    tune(docs.sparkSession)
    path = path or tokens.default_path()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches):
        import pyarrow as pa

        enc, last = tokens.encoder(path, cache_words), np.asarray([end_id], "<u4").tobytes()
        for batch in chunks(batches, 4 << 20, "__text"):
            raw, at = utf8(batch.column(batch.num_columns - 1))
            raw, at = raw.tobytes(), at.tolist()
            rows, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(enc.encode([raw[a:b] for a, b in zip(at, at[1:], strict=False)])):
                ids += last
                for k, a in enumerate(range(0, len(ids), 4 * cap)):
                    part = ids[a : a + 4 * cap]
                    rows.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            index = pa.array(rows, pa.int64())
            kept = [batch.column(i).take(index) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=[*keep, "piece", "start", "length", "ids_crc32"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(lean(run, keeps_words=True), f"{fields}, {PIECE}")


def pack(pieces: DataFrame, cap: int = CAP) -> DataFrame:
    """pieces (which must not change between reads) with sequence_id and offset."""
    spark = pieces.sparkSession
    hist = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not hist:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    # For each length: ranks from lo on belong to bins from base on, which hold `each` items of the length, first at `place`.
    runs: list[tuple[int, int, int, int, int]] = []
    taken, base = dict.fromkeys(hist, 0), 0
    for items, times in plan(hist, cap):
        place = 0
        for l in sorted(set(items), reverse=True):
            each = items.count(l)
            runs.append((l, taken[l], base, each, place))
            taken[l] += each * times
            place += each * l
        base += times
    assert taken == hist
    runs.sort()
    r_len, r_lo, r_base, r_each, r_place = (np.asarray(x, np.int64) for x in zip(*runs, strict=True))
    r_key = r_len << 48 | r_lo

    sizes = spark.createDataFrame([(l, -(-n // RANK_ROWS)) for l, n in hist.items()], "l long, buckets long")
    order = [c for c in pieces.columns if c != "length"]
    dealt = pieces.join(F.broadcast(sizes), F.col("length") == F.col("l")).withColumn("bucket", F.pmod(F.xxhash64(*order), F.col("buckets"))).drop("l", "buckets")
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = written(counts.select(F.col("length").alias("l"), F.col("bucket").alias("b"), (F.sum("n").over(upto) - F.col("n")).alias("before")), "ranks")
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1)
    ranked = ranked.join(sized(offsets, 40), (F.col("length") == F.col("l")) & (F.col("bucket") == F.col("b")))
    ranked = ranked.select(*pieces.columns, (F.col("rank") + F.col("before")).cast("long").alias("rank"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def place_all(batches):
        import pyarrow as pa

        for batch in batches:
            l = np.asarray(batch.column(batch.schema.get_field_index("length")))
            rank = np.asarray(batch.column(batch.num_columns - 1))
            at = np.searchsorted(r_key, l << 48 | rank, "right") - 1
            nth = rank - r_lo[at]
            seq, offset = r_base[at] + nth // r_each[at], r_place[at] + nth % r_each[at] * l
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seq), pa.array(offset)], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(lean(place_all), fields)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(written(cut(documents(spark, sf_dir)), "pieces"))
