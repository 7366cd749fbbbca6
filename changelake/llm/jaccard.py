"""N-gram Jaccard join: exact links between documents whose shingle sets are similar, by regions of a metric space.

Jaccard distance is a metric, so if two sets are within t = 1 - similarity, their distances to any pivot differ by at
most t. The join works by regions that get smaller, each exact:

1. Equal sets are one node (a 128-bit signature); copies never meet as pairs.
2. Texts hardly overlap, so most distances to any document are 1 and document pivots alone part nothing. The first pivot
   is the empty set, under the other metric of sets, the size d of the symmetric difference: the distance to it is a
   set's size, and regions are size classes; a set also enters every larger class that a similar set may lie in (triangle
   inequality). Similar sets of a class have d <= k, a bound by the class's largest size. Hashes part all shingles into
   more than k slots; d is the sum over slots, so similar sets agree in some slot that isn't empty. Each set enters the
   region of each of its slots' contents; sets with so many empty slots that this proves nothing enter the regions of
   their empty slots, too.
3. Regions that share sets are merged (connected components of the candidate graph). Where that makes a region larger
   than REGION_NODES sets or REGION_SHINGLES shingles, its sets are sent again with a parity sketch: each shingle flips one
   bit, so two sketches differ in at most d bits. Pairs that meet in a region and pass the bound are the edges now.
4. A merged region that is still too large is split by document pivots into Voronoi cells: a set goes to the cell of its
   nearest pivot and to every cell whose pivot is within 2 t of that; sets that share nothing with any pivot form cells by
   size. This recurs; what no pivot splits is joined block by block. Sets are fetched for nodes that share a region only.
5. Within a region, sets in order of size meet those in their size window that share a shingle of their prefix, lie
   within t of them by every pivot seen so far, and aren't in their component yet; those are compared exactly.
6. To count links, every pair of a region is compared, in blocks: common shingles by matrix products, rare ones by their
   lists. Only counts leave the task, so nothing grows with the square of a group but the comparing. Where cells overlap,
   a pair counts in the first cell that both sets are in.

Defined results: null text and texts without words have no shingles and link with nothing; rows with a null doc_id take
no part in links and get a null component_id; repeated rows and copies share a component; several texts of one doc_id
are that one document's texts, and link its components; n_links counts the links of a row's text, one for each other text
of a document (doc_id and set of shingles) that is similar or equal, 0 without shingles or doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BESIDE_TEXTS, chunks, documents, lean, mix64, sized, tune, utf8, written
from .graphs import components
from .shingles import shingle_sets, signature

WORDS, PERCENT = 4, 85
#: Size classes grow by this ratio; postings of one block, and of one bucket of the shuffle (16 bytes each).
CLASS_RATIO = 1.5
BLOCK_POSTINGS, BUCKET_POSTINGS = 1 << 19, 1 << 20
#: Postings with sketches are dealt by size class, too, so their buckets are larger; a sketch goes once to each bucket.
SKETCHED_POSTINGS = 1 << 24
REGION_NODES, REGION_SHINGLES = 16_384, 4_000_000
PIVOTS, MOST_SPLITS = 16, 5
BATCH_BYTES = 1 << 20
#: Counting links: sets of one step; cells of the matrix of common shingles, and of what is unfolded of the rare ones' lists.
STEP_SETS, DENSE_CELLS, UNFOLDED = 128, 1 << 24, 1 << 21
SET = ("region", "rep", "n", "shingles", "hi", "copies", "lower")
SET_SCHEMA = "region string, rep long, n long, shingles binary, hi long, copies long, lower binary"


def needed(n, percent: int):
    """How many shingles of n a set must share with any similar set."""
    return -(-n * percent // 100)


def survey(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n and the signature (hi, lo) of every document's set."""
    tune(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches, BATCH_BYTES):
            sets = shingle_sets(*utf8(batch.column(1)), words)
            hi, lo = zip(*map(signature, sets), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], names=["doc_id", "n", "hi", "lo"])

    return written(docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n long, hi long, lo long"), "sets")


def class_tops(most: int) -> np.ndarray:
    """The largest sizes of the classes, up to one that holds `most`."""
    tops = [4]
    while tops[-1] < most:
        tops.append(int(tops[-1] * CLASS_RATIO) + 1)
    return np.asarray(tops, np.int64)


def region_keys(s: np.ndarray, percent: int, tops: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """For each size class that a set (sorted distinct hashes) enters: the class, its k, and the keys of its regions."""
    n = len(s)
    c = int(np.searchsorted(tops, n))
    keys = []
    for tag in range(c, min(int(np.searchsorted(tops, n * 100 // percent)), len(tops) - 1) + 1):
        k = int(tops[tag]) * (100 - percent) // percent
        slots = k + 1 + k // 8
        slot = ((s >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        mark = mix64(np.uint64(tag + 1) * np.uint64(1 << 40) + slot[first].astype(np.uint64))
        own = mix64(np.add.reduceat(mix64(s), first) ^ mark)
        if len(first) <= k:
            empty = np.setdiff1d(np.arange(slots), slot[first])
            own = np.r_[own, mix64(mix64(np.uint64(tag + 1) * np.uint64(1 << 40) + empty.astype(np.uint64)) ^ np.uint64(0x5851F42D4C957F2D))]
        keys.append((tag, k, own))
    return keys


def candidate_edges(docs: DataFrame, words: int, percent: int, shingles: int, most: int) -> DataFrame:
    """Star edges (a, b) between nodes that share a region. A node is the first half of a signature. Postings (key, node)
    travel as blocks of bytes in buckets by key; shingles (the corpus's sum of set sizes) gives the number of buckets."""
    buckets = max(16, -(-shingles // 3 // BUCKET_POSTINGS))
    tops = class_tops(most)

    def run(batches):
        import pyarrow as pa

        keys, nodes, size = [], [], 0

        def regions():
            """Distinct postings; where several nodes of this block share a region, the first stands for all, and the
            others are tied to it by a region of their own."""
            k, v = np.concatenate(keys), np.concatenate(nodes)
            at = np.lexsort((v, k))
            k, v = k[at], v[at]
            new = np.r_[True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])]
            k, v = k[new], v[new]
            first = np.r_[True, k[1:] != k[:-1]]
            head = v[np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))]
            ties = np.unique(np.c_[v[~first], head[~first]], axis=0)
            tie = mix64(ties[:, 0].view(np.uint64) + mix64(np.ascontiguousarray(ties[:, 1]).view(np.uint64))) if len(ties) else np.zeros(0, np.uint64)
            k, v = np.r_[k[first], tie, tie], np.r_[v[first], ties[:, 0], ties[:, 1]]
            to = ((k >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            at = np.argsort(to, kind="stable")
            k, v, to = k[at], v[at], to[at]
            cuts = np.r_[np.flatnonzero(np.r_[True, to[1:] != to[:-1]]), len(to)].tolist()
            rows = [(int(to[a]), k[a:b].tobytes() + v[a:b].tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
            for a in range(0, len(rows), 64):
                t, d = zip(*rows[a : a + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(d, pa.binary())], names=["bucket", "postings"])

        for batch in chunks(batches, BATCH_BYTES):
            for s in shingle_sets(*utf8(batch.column(0)), words):
                if len(s):
                    keys.append(np.concatenate([own for _, _, own in region_keys(s, percent, tops)]))
                    nodes.append(np.full(len(keys[-1]), signature(s)[0], np.int64))
                    size += len(keys[-1])
            if size >= BLOCK_POSTINGS:
                yield from regions()
                keys, nodes, size = [], [], 0
        if size:
            yield from regions()

    def stars(batches):
        import pyarrow as pa

        bucket, held = None, []

        def done():
            k = np.concatenate([np.frombuffer(d[: len(d) // 2], np.uint64) for d in held])
            v = np.concatenate([np.frombuffer(d[len(d) // 2 :], np.int64) for d in held])
            at = np.lexsort((v, k))
            k, v = k[at], v[at]
            first = np.r_[True, k[1:] != k[:-1]]
            head = v[np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))]
            e = np.unique(np.c_[v, head][head != v], axis=0)
            for a in range(0, len(e), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(e[a : a + (1 << 16), 0]), pa.array(e[a : a + (1 << 16), 1])], names=["a", "b"])

        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket and held:
                    yield from done()
                    held = []
                bucket = b
                held.append(data)
        if held:
            yield from done()

    posted = docs.where("doc_id IS NOT NULL").select("text").mapInArrow(lean(run), "bucket int, postings binary")
    return posted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lean(stars), "a long, b long")


def sketch(s: np.ndarray, bits: int) -> np.ndarray:
    """The parity of how many shingles hash to each bit."""
    place = (mix64(s + np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def near_pairs(k: np.ndarray, v: np.ndarray, n: np.ndarray, sketches: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of indexes v that meet under a key k and may be similar by size and sketch; of groups over 64 members, enough
    pairs to connect what such pairs connect."""
    order = np.lexsort((v, k))
    k, v = k[order], v[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[first, len(k)])
    first, size = first[size > 1], size[size > 1]
    if not len(first):
        return np.zeros((0, 2), np.int64)
    # Near copies meet under many keys: groups of the same members count once.
    whole = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(whole)) - np.repeat(np.cumsum(size) - size, size) + first[whole]
    members = v[at]
    mark = np.add.reduceat(mix64(members.astype(np.uint64) + np.uint64(1)), np.cumsum(size) - size)
    _, one = np.unique(mark, return_index=True)
    first, size = first[one], size[one]

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        least, most = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        fits = 100 * least >= percent * most
        out = np.zeros(len(a), bool)
        for i in range(0, len(a), 1 << 16):
            j = slice(i, i + (1 << 16))
            out[j] = np.bitwise_count(sketches[a[j]] ^ sketches[b[j]]).sum(1, dtype=np.int64) <= least[j] * (100 - percent) // percent
        return out & fits

    found = []
    few = size <= 64
    for step in range(1, 64):
        starts, sizes = first[few & (size > step)], size[few & (size > step)]
        if not len(starts):
            break
        i = np.repeat(starts - (np.cumsum(sizes - step) - (sizes - step)), sizes - step) + np.arange(int((sizes - step).sum()))
        found.append(np.unique(v[i] * len(n) + v[i + step]))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    a, b = pairs // max(1, len(n)), pairs % max(1, len(n))
    keep = near(a, b)
    out = [np.c_[a[keep], b[keep]]]
    for f, m in zip(first[~few].tolist(), size[~few].tolist(), strict=True):
        group = v[f : f + m]
        group = group[np.argsort(n[group], kind="stable")]
        label, reach = np.arange(m), np.searchsorted(n[group], n[group] * 100 // percent, "right")
        for x in range(m):
            ys = x + 1 + np.flatnonzero(label[x + 1 : reach[x]] != label[x])
            ys = ys[near(np.full(len(ys), group[x]), group[ys])] if len(ys) else ys
            if len(ys):
                out.append(np.c_[np.full(len(ys), group[x]), group[ys]])
                old = np.unique(np.r_[label[ys], label[x]])
                label[np.isin(label, old)] = old[0]
    return np.concatenate(out)


def refined_edges(texts: DataFrame, words: int, percent: int, shingles: int, most: int) -> DataFrame:
    """Edges (a, b) between reps that meet in a region and pass the sketch's bound, from texts (rep, hi, lo, text)."""
    buckets = max(4, -(-shingles // 3 // SKETCHED_POSTINGS))
    tops = class_tops(most)

    def run(batches):
        import pyarrow as pa

        by_tag: dict[int, list] = {}
        size = 0

        def flush():
            for tag, rows in by_tag.items():
                reps, ns = np.asarray([r[0] for r in rows], "<i8"), np.asarray([r[1] for r in rows], "<i8")
                keys = np.concatenate([r[2] for r in rows])
                at = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
                marks = np.stack([r[3] for r in rows])
                to = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                for b in np.unique(to).tolist():
                    mine = to == b
                    here, index = np.unique(at[mine], return_inverse=True)
                    cols = (keys[mine].tobytes(), index.astype("<i4").tobytes(), reps[here].tobytes(), ns[here].tobytes(), marks[here].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([tag], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=["bucket", "tag", "keys", "at", "reps", "ns", "sketches"])

        for batch in chunks(batches, BATCH_BYTES):
            reps, hi, lo = (batch.column(i).to_pylist() for i in range(3))
            for i, s in enumerate(shingle_sets(*utf8(batch.column(3)), words)):
                if signature(s) != (hi[i], lo[i]):
                    continue
                for tag, k, keys in region_keys(s, percent, tops):
                    bits = 512
                    while bits < 2 * k:
                        bits *= 2
                    by_tag.setdefault(tag, []).append((reps[i], len(s), keys, sketch(s, bits)))
                    size += len(keys)
            if size >= BLOCK_POSTINGS:
                yield from flush()
                by_tag.clear()
                size = 0
        yield from flush()

    def pairs(batches):
        import pyarrow as pa

        key, held = None, []

        def done():
            base = np.cumsum([0, *(len(h[2]) // 8 for h in held)])
            k = np.concatenate([np.frombuffer(h[0], np.uint64) for h in held])
            v = np.concatenate([np.frombuffer(h[1], "<i4") + b for h, b in zip(held, base, strict=False)]).astype(np.int64)
            reps = np.concatenate([np.frombuffer(h[2], "<i8") for h in held])
            n = np.concatenate([np.frombuffer(h[3], "<i8") for h in held])
            marks = np.concatenate([np.frombuffer(h[4], np.uint64).reshape(len(h[2]) // 8, -1) for h in held])
            e = near_pairs(k, v, n, marks, percent)
            for a in range(0, len(e), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(reps[e[a : a + (1 << 16), 0]]), pa.array(reps[e[a : a + (1 << 16), 1]])], names=["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key and held:
                    yield from done()
                    held = []
                key = row[:2]
                held.append(row[2:])
        if held:
            yield from done()

    posted = texts.mapInArrow(lean(run), "bucket int, tag int, keys binary, at binary, reps binary, ns binary, sketches binary")
    return posted.repartition("bucket", "tag").sortWithinPartitions("bucket", "tag").mapInArrow(lean(pairs), "a long, b long")


class Region:
    """Sets of one region, compared exactly. sets: sorted distinct hashes of each."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.t = percent, 1 - percent / 100
        self.n = np.asarray([len(s) for s in sets])
        self.at = np.r_[0, np.cumsum(self.n)]
        flat = np.concatenate(sets)
        _, self.flat, df = np.unique(flat, return_inverse=True, return_counts=True)
        self.seen = np.zeros(len(df), bool)
        self.df = df
        self.lists = None

    def _index(self) -> None:
        """For each shingle the sets that have it in their prefix, rarest shingles first."""
        tokens, owners = [], []
        self.prefix = []
        for i, n in enumerate(self.n.tolist()):
            own = self.flat[self.at[i] : self.at[i + 1]]
            p = n - int(needed(n, self.percent)) + 1
            rank = np.lexsort((own, self.df[own]))[:p]
            own = own[rank]
            own = own[self.df[own] > 1]
            self.prefix.append(own)
            tokens.append(own)
            owners.append(np.full(len(own), i))
        tokens, owners = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(tokens, kind="stable")
        self.owners = owners[order]
        self.lists = np.searchsorted(tokens[order], np.arange(len(self.df) + 1))

    def common(self, x: int, ys: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set x with the sets ys (ascending)."""
        own = self.flat[self.at[x] : self.at[x + 1]]
        self.seen[own] = True
        if len(ys) * 3 > ys[-1] - ys[0]:
            a, b = self.at[ys[0]], self.at[ys[-1] + 1]
            run = np.r_[0, np.cumsum(self.seen[self.flat[a:b]])]
            got = run[self.at[ys + 1] - a] - run[self.at[ys] - a]
        else:
            got = np.asarray([np.count_nonzero(self.seen[self.flat[self.at[y] : self.at[y + 1]]]) for y in ys.tolist()])
        self.seen[own] = False
        return got

    def labels(self) -> np.ndarray:
        """The smallest index of each set's component; the sets must come in order of size."""
        m, n = len(self.n), self.n
        label = np.arange(m)
        pivots: list[np.ndarray] = []
        last = np.searchsorted(n, n * 100 // self.percent, "right")
        if m > 64:
            self._index()
        for x in range(m):
            ys = x + 1 + np.flatnonzero(label[x + 1 : last[x]] != label[x])
            if not len(ys):
                continue
            if self.lists is not None and len(ys) > 16:
                lists = [self.owners[self.lists[t] : self.lists[t + 1]] for t in self.prefix[x].tolist()]
                if not lists:
                    continue
                hit = np.zeros(m, bool)
                for one in lists:
                    hit[one] = True
                ys = ys[hit[ys]]
            for d in pivots:  # triangle inequality; nan where a distance isn't known
                ys = ys[~(np.abs(d[ys] - d[x]) > self.t + 1e-9)]
            if not len(ys):
                continue
            both = self.common(x, ys)
            union = n[x] + n[ys] - both
            if len(ys) >= 32 and len(pivots) < PIVOTS:
                d = np.full(m, np.nan)
                d[x], d[ys] = 0.0, 1 - both / union
                pivots.append(d)
            linked = ys[100 * both >= self.percent * union]
            if len(linked):
                old = np.unique(np.r_[label[linked], label[x]])
                label[np.isin(label, old)] = old[0]
        return label

    def links(self, copies: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """The copies of all other sets that link with each set; lower: for each split, the cells before this one that a
        set is in. The sets must come in order of size."""
        m, n = len(self.n), self.n
        owner = np.repeat(np.arange(m), n)
        common = np.flatnonzero(self.df > 1)
        common = common[np.argsort(-self.df[common], kind="stable")][: max(1, DENSE_CELLS // m)]
        column = np.full(len(self.df), -1)
        column[common] = np.arange(len(common))
        at = column[self.flat]
        dense = np.zeros((m, len(common)), np.float32)
        dense[owner[at >= 0], at[at >= 0]] = 1
        rare = np.flatnonzero((at < 0) & (self.df[self.flat] > 1))
        by_token = rare[np.argsort(self.flat[rare], kind="stable")]
        lists = np.searchsorted(self.flat[by_token], np.arange(len(self.df) + 1))
        owners = owner[by_token]
        last = np.searchsorted(n, n * 100 // self.percent, "right")
        total = np.zeros(m, np.int64)
        for a in range(0, m, STEP_SETS):
            b = min(m, a + STEP_SETS)
            width = int(last[b - 1]) - a
            both = (dense[a:b] @ dense[a : a + width].T).astype(np.int64)
            mine = rare[np.searchsorted(rare, self.at[a]) : np.searchsorted(rare, self.at[b])]
            sizes = self.df[self.flat[mine]]
            part = (np.cumsum(sizes) - 1) // UNFOLDED
            for k in np.unique(part):
                e, size = mine[part == k], sizes[part == k]
                i = np.arange(int(size.sum())) + np.repeat(lists[self.flat[e]] - (np.cumsum(size) - size), size)
                x, y = np.repeat(owner[e], size) - a, owners[i] - a
                here = (y >= 0) & (y < width)
                both += np.bincount(x[here] * width + y[here], minlength=(b - a) * width).reshape(b - a, width)
            linked = 100 * both >= self.percent * (n[a:b, None] + n[None, a : a + width] - both)
            linked &= np.arange(width)[None, :] > np.arange(b - a)[:, None]
            for level in lower.T:
                linked &= (level[a:b, None] & level[None, a : a + width]) == 0
            total[a:b] += linked @ copies[a : a + width]
            total[a : a + width] += copies[a:b] @ linked
        return total


def solve(sets: DataFrame, percent: int, counted: bool = False) -> DataFrame:
    """From sets (SET), star edges (a, b) of reps that link within a region; if counted, also rows (node, links)."""

    def run(batches):
        import pyarrow as pa

        region, held, out = None, {}, []

        def done():
            sets = sorted(held.values(), key=lambda h: (len(h[2]), h[1]))
            within = Region([h[2] for h in sets], percent)
            rows = [(sets[i][1], sets[l][1], None, None) for i, l in enumerate(within.labels().tolist()) if i != l]
            if counted:
                lower = np.frombuffer(b"".join(h[4] for h in sets), "<u4").reshape(len(sets), -1)
                links = within.links(np.asarray([h[3] for h in sets], np.int64), lower)
                rows += [(None, None, h[0], c) for h, c in zip(sets, links.tolist(), strict=True) if c]
            return rows

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b", "node", "links"])

        for batch in batches:
            for r, rep, _, s, hi, copies, lower in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != region:
                    out += done() if len(held) > 1 else []
                    region, held = r, {}
                    if len(out) > 10_000:
                        yield batch_of(out)
                        out = []
                held[hi] = (hi, rep, np.frombuffer(s, np.uint64), copies, lower)  # a repeated row brings its set again
        out += done() if len(held) > 1 else []
        if out:
            yield batch_of(out)

    placed = sets.select(*SET).repartition("region").sortWithinPartitions("region")
    return placed.mapInArrow(lean(run), "a long, b long, node long, links long")


def distances(sets: list[np.ndarray], pivots: list[np.ndarray]) -> np.ndarray:
    """Jaccard distances of sets to pivots."""
    out = np.ones((len(sets), len(pivots)))
    flat, n = np.concatenate(sets), np.asarray([len(s) for s in sets])
    at = np.r_[0, np.cumsum(n)]
    for j, p in enumerate(pivots):
        i = np.minimum(np.searchsorted(p, flat), len(p) - 1)
        run = np.r_[0, np.cumsum(p[i] == flat)]
        both = run[at[1:]] - run[at[:-1]]
        out[:, j] = 1 - both / (n + len(p) - both)
    return out


def split(sets: DataFrame, percent: int) -> DataFrame:
    """Every region's sets by Voronoi cells of up to PIVOTS document pivots: the same columns, with cells as regions."""
    spark = sets.sparkSession
    counts = sets.groupBy("region").agg(F.count("*").alias("m"))
    thin = F.greatest(F.lit(1), F.floor(F.col("m") / (4 * PIVOTS))).cast("long")
    some = sets.join(sized(counts, 24), "region").where(F.pmod(F.xxhash64("rep", F.lit(3)), thin) == 0)
    some = some.groupBy("region").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("rep").alias("h"), "shingles"))), 1, PIVOTS).alias("pivots"))
    some = written(some.select("region", F.col("pivots.shingles").alias("pivots"), F.aggregate("pivots.shingles", F.lit(0), lambda n, p: n + F.octet_length(p)).alias("bytes")), "pivots")
    rows = sets.join(sized(some, 32, "bytes"), "region", "left").select(*SET, "pivots")
    t = 1 - percent / 100

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            regions, reps, ns, raws, nodes, copies, lower, pivots = (c.to_pylist() for c in batch.columns)
            out = []
            for region in dict.fromkeys(regions):
                mine = [i for i, r in enumerate(regions) if r == region]
                around = [np.frombuffer(p, np.uint64) for p in pivots[mine[0]] or []]
                if not around:
                    d = np.ones((len(mine), 1))
                else:
                    d = distances([np.frombuffer(raws[i], np.uint64) for i in mine], around)
                for i, row in zip(mine, d, strict=True):
                    near = row.min()
                    # A set is in the cells whose pivot it overlaps, within 2 t of its nearest pivot ...
                    js = np.flatnonzero((row <= near + 2 * t + 1e-9) & (row < 1)).tolist()
                    cells = [(f"{region}/{j}", sum(1 << o for o in js if o < j)) for j in js]
                    # ... and, as far as it may be near a set that overlaps no pivot, in the cells of its size.
                    if near >= 1 - t - 1e-9:
                        band = int(np.floor(np.log(ns[i]) / -np.log(percent / 100) + 1e-9))
                        before = sum(1 << o for o in js)
                        cells += [(f"{region}/size{band}", before), (f"{region}/size{band + 1}", before | 1 << 31)]
                    out += [(c, reps[i], ns[i], raws[i], nodes[i], copies[i], lower[i] + mask.to_bytes(4, "little")) for c, mask in cells]
            for a in range(0, len(out), 500):
                cols = list(zip(*out[a : a + 500], strict=True))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)], names=list(SET))

    return rows.mapInArrow(lean(run), SET_SCHEMA)


def blocked(sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Regions that no pivot splits: every pair of blocks of a region becomes a region of its own."""
    blocks = F.greatest(F.ceil(F.col("m") / (REGION_NODES // 2)), F.ceil(F.col("total") / (REGION_SHINGLES // 2))).cast("long")
    rows = sets.join(sized(sizes.withColumn("blocks", blocks), 64), "region").withColumn("own", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.concat_ws("/", "region", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
    # Sets of one block meet in many cells; they count in the one of their block alone.
    side = F.when(F.col("own") < F.col("other"), F.expr("X'01000000'")).when(F.col("own") > F.col("other"), F.expr("X'02000000'")).otherwise(F.expr("X'00000000'"))
    return rows.withColumn("lower", F.concat("lower", side)).select(cell.alias("region"), *SET[1:])


def large_links(sets: DataFrame, percent: int, counted: bool = False) -> DataFrame:
    """Links within regions too large for one task, by Voronoi cells, recursively."""
    spark, found, parent = sets.sparkSession, [], None
    small = (F.col("m") <= REGION_NODES) & (F.col("total") <= REGION_SHINGLES)
    for _ in range(MOST_SPLITS):
        cells = written(split(sets, percent), "cells")
        sizes = written(cells.groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("total")), "sizes")
        found.append(solve(cells.join(sized(sizes.where(small), 64), "region"), percent, counted))
        rest = sizes.where(~small)
        if rest.isEmpty():
            sets = None
            break
        sets = cells.join(sized(rest, 64), "region").select(*SET)
        total = rest.agg(F.sum("m")).first()[0]
        if parent is not None and total > 0.9 * parent:
            break  # pivots no longer split them
        parent = total
    if sets is not None:
        sizes = written(sets.groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("total")), "sizes")
        found.append(solve(blocked(sets, sizes), percent, counted))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, counted: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; if counted, also n_links."""
    spark = docs.sparkSession
    every = survey(docs, words)
    named = every.where("n > 0 AND doc_id IS NOT NULL")
    nodes = (named.distinct() if counted else named).groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    nodes = written(nodes, "nodes")
    totals = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    merged = components(candidate_edges(docs, words, percent, *totals))
    inside = nodes.join(merged, F.col("hi") == F.col("node")).select(F.col("root").alias("region"), "rep", "hi", "lo", "n", "copies")
    wanted, large = regions(written(inside, "inside"))
    if large is not None:
        # Merged regions that grew too large: once more, with the sketches' bound on every pair that meets.
        sums = large.agg(F.sum("n"), F.max("n")).first()
        texts = docs.select("doc_id", "text").join(sized(large, 48, most=BESIDE_TEXTS), F.col("doc_id") == F.col("rep")).select("rep", "hi", "lo", "text")
        finer = components(refined_edges(texts, words, percent, *sums))
        finer = large.join(finer, F.col("rep") == F.col("node")).select(F.col("root").alias("region"), "rep", "hi", "lo", "n", "copies")
        finer, large = regions(written(finer, "finer"))
        # Reps stand for regions of either round; the sign keeps them apart.
        wanted = wanted.unionByName(finer.withColumn("region", F.struct(F.lit(1).alias("round"), F.col("region.region").alias("region"))))
    solved = solve(fetch(docs, written(wanted, "wanted"), words), percent, counted)
    if large is not None:
        solved = solved.unionByName(large_links(written(fetch(docs, large, words), "large"), percent, counted))
    solved = written(solved, "solved") if counted else solved
    edges = solved.where("a IS NOT NULL").select("a", "b")
    # A doc_id that has several texts ties their components.
    several = named.select("doc_id", "hi", "lo", "n").distinct().groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1")
    extra = named.join(sized(several, 32), "doc_id").join(nodes, ["hi", "lo", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = written(components(edges.unionByName(extra)), "roots")
    copied = nodes.where("copies > 1").select("hi", "lo", "rep", "copies")
    out = every.join(sized(written(copied, "copied"), 40), ["hi", "lo"], "left")
    out = out.withColumn("rep", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")))
    out = out.join(sized(roots, 32), F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("root", "rep")).otherwise(F.col("doc_id")))
    columns = ["doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")]
    if not counted:
        return out.select(*columns)
    links = written(solved.where("node IS NOT NULL").groupBy(F.col("node").alias("hi")).agg(F.sum("links").alias("links")), "links")
    out = out.withColumnRenamed("node", "root_of").join(sized(links, 16), "hi", "left")
    n_links = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).otherwise(0)
    return out.select(*columns, n_links.cast("long").alias("n_links"))


def regions(inside: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Of (region, rep, hi, lo, n), regions with several nodes: those small enough for one task, and the others, if any."""
    sizes = inside.groupBy("region").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1")
    sizes = written(sizes, "regions")
    small = (F.col("m") <= REGION_NODES) & (F.col("total") <= REGION_SHINGLES)
    pick = lambda rows: inside.join(sized(rows.select("region"), 16), "region", "left_semi").select(F.struct(F.lit(0).alias("round"), F.col("region")).alias("region"), "rep", "hi", "lo", "n", "copies")
    large = sizes.where(~small)
    return pick(sizes.where(small)), None if large.isEmpty() else written(pick(large), "oversize")


def fetch(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The sets (SET) of the nodes wanted, from the text of the document that stands for each."""
    texts = docs.select("doc_id", "text").join(sized(wanted, 64, most=BESIDE_TEXTS), F.col("doc_id") == F.col("rep")).select(F.col("region").cast("string").alias("region"), "rep", "hi", "lo", "n", "copies", "text")

    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches, BATCH_BYTES):
            sets = shingle_sets(*utf8(batch.column(6)), words)
            hi, lo = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            # The doc_id may have other texts, too.
            mine = pa.array([i for i, s in enumerate(sets) if signature(s) == (hi[i], lo[i])], pa.int64())
            part = batch.take(mine)
            raws = pa.array([sets[i].tobytes() for i in mine.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(4), raws, part.column(2), part.column(5), pa.array([b""] * len(mine), pa.binary())], names=list(SET))

    return texts.mapInArrow(lean(run), SET_SCHEMA)


def op2_jaccard_components(spark, sf_dir: str) -> DataFrame:
    return link(documents(spark, sf_dir), counted=True)
