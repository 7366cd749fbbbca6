"""The operators of changelake.llm against brute force, and their edge cases: nulls in any column, empty and long texts, ties,
repeated rows, empty tables, and other columns whose names clash with the operators' own."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from changelake.llm import flac, jaccard, knn, language, mixing, packing, quality, repeats, token_files, tokens, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, key string, spans string, rep long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def docs_frame(spark, texts, langs=None, sources=None):
    rows = [(i, t, langs[k % len(langs)] if langs else "en", sources[k % len(sources)] if sources else "s", len(t or ""), "x", "y", "z", -1) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="module")
def texts(words):
    """Odd texts, copies, near copies, shared passages, long ones."""
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base, line = say(90), [rng.choice(words) for _ in range(120)], say(12)
    out = [None, "", " \n\t ", "a", "one two", "one two", "ONE  two", "é ü ñ 漢字", "x" * 5000, "ab " * 900, "ab " * 900 + "!", say(6000)]
    out += [say(rng.randint(5, 150)) for _ in range(25)]
    out += [say(40) + " " + passage + " " + say(30) for _ in range(4)] + [passage] * 3 + [line + "\n" + say(50) for _ in range(6)]
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(len(near))] = rng.choice(words)
        out.append(" ".join(near))
    return [(i, t) for i, t in enumerate(out)] + [(None, "one two"), (5, "one two"), (None, None)]


# 1


def brute_top(vectors, queries, k):
    out = []
    for q, v in queries:
        scored = sorted({(-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q})[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.random()]) for _ in range(6)], "c", 1) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.5, 0.0, 0.0, 0.0], "c", 2) for i in range(300, 420)]  # many equal vectors
    odd = [(500, None, "c", 3), (501, [1.0, None], "c", 3), (502, [float("nan")], "c", 3), (503, [float("inf")], "c", 3), (None, [1.0] * 6, "c", 3), (504, [], "c", 4), (505, [0.5, 0.5], "c", 4), (506, [1e30, 1.0], "c", 5)]
    schema = "vec_id long, embedding array<double>, rank string, cell int"
    df = spark.createDataFrame(rows + rows[:7], schema)
    whole = [(i, [int(np.floor(256 * x)) for x in e]) for i, e, _, _ in rows]
    want = brute_top(whole, [(i, v) for i, v in whole if i % 10 == 0], 5)
    assert sorted(map(tuple, knn.top_k(df, knn.F.col("vec_id") % 10 == 0).collect())) == want
    # Odd rows: those that take no part change nothing; others count with zeros for what they lack.
    more = spark.createDataFrame(rows + odd[:7], schema)
    extra = whole + [(504, [0] * 6), (505, [128, 128, 0, 0, 0, 0])]
    assert sorted(map(tuple, knn.top_k(more, knn.F.col("vec_id") % 10 == 0).collect())) == brute_top(extra, [(i, v) for i, v in extra if i % 10 == 0], 5)
    big = knn.top_k(spark.createDataFrame(rows[:20] + odd[7:], schema), knn.F.col("vec_id") == 506, 2).collect()
    assert len(big) == 2
    few = knn.top_k(spark.createDataFrame(rows[:3], schema), knn.F.lit(True)).collect()
    assert Counter(r.query_id for r in few) == {0: 2, 1: 2, 2: 2}
    assert knn.top_k(df.limit(0), knn.F.lit(True)).count() == 0


def test_top_k_of_repeated_rows(spark):
    # The only query is the only pivot, and its repeats lie nearer to it than any neighbour.
    first = spark.range(40).orderBy(knn.F.xxhash64("id"), "id").first().id
    vector = lambda i: [float(j == i % 4) + (j == 4 + i % 3) / 2 for j in range(8)]
    rows = [(i, vector(i)) for i in range(40)] + [(first, vector(first))] * 9
    # One vec_id with many vectors of equal score, and one with several scores.
    rows += [(50, [float(j == first % 4) + (j == 4 + first % 3) / 2 + (j == 7) * n for j in range(8)]) for n in range(1, 9)] + [(51, vector(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [int(np.floor(256 * x)) for x in e]) for i, e in rows]
    want = brute_top(whole, {(i, tuple(v)) for i, v in whole if i == first}, 5)
    for parts in (1, 5):
        assert sorted(map(tuple, knn.top_k(df.repartition(parts), knn.F.col("vec_id") == int(first)).collect())) == want


# 2


def brute_links(rows, words, percent):
    sets, by_id = [], defaultdict(set)
    for i, t in rows:
        w = [x.lower() for x in WORD.findall((t or "").encode())]
        sets.append((i, {tuple(w[a : a + words]) for a in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, u in sets[:a]:
            if i is not None and j is not None and s and u and 100 * len(s & u) >= percent * len(s | u):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    del by_id
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


@pytest.mark.parametrize("limits", [None, (4, 2000, 5), (3, 400, 1)])
def test_jaccard(spark, texts, monkeypatch, limits):
    if limits:
        for name, value in zip(("REGION_NODES", "REGION_SHINGLES", "MOST_SPLITS"), limits, strict=True):
            monkeypatch.setattr(jaccard, name, value)
    for words, percent in ((4, 85), (2, 60)):
        got = sorted(map(tuple, jaccard.link(docs_frame(spark, texts), words, percent).collect()), key=repr)
        assert got == brute_links(texts, words, percent)


def brute_counts(rows, words, percent):
    sets = []
    for i, t in rows:
        w = [x.lower() for x in WORD.findall((t or "").encode())]
        sets.append((i, frozenset(tuple(w[a : a + words]) for a in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])))
    known = {(i, s) for i, s in sets if i is not None and s}
    near = lambda s, u: 100 * len(s & u) >= percent * len(s | u)
    return Counter((i, len(s), sum((j, u) != (i, s) and near(s, u) for j, u in known) if i is not None and s else 0) for i, s in sets)


@pytest.mark.parametrize("limits", [None, (4, 2000, 5), (3, 400, 1)])
def test_jaccard_counts_links(spark, texts, monkeypatch, limits):
    if limits:
        for name, value in zip(("REGION_NODES", "REGION_SHINGLES", "MOST_SPLITS"), limits, strict=True):
            monkeypatch.setattr(jaccard, name, value)
    for words, percent in ((4, 85), (2, 60)):
        got = jaccard.link(docs_frame(spark, texts), words, percent, counted=True).collect()
        assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in got) == brute_counts(texts, words, percent)
        assert sorted((tuple(r)[:3] for r in got), key=repr) == brute_links(texts, words, percent)


def test_links_within_a_region(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(jaccard, "STEP_SETS", 7)
    for cells, unfolded in ((1 << 20, 1 << 20), (300, 50), (1, 9)):
        monkeypatch.setattr(jaccard, "DENSE_CELLS", cells)
        monkeypatch.setattr(jaccard, "UNFOLDED", unfolded)
        base = rng.integers(1, 2**60, 60).astype(np.uint64)
        sets = sorted((np.unique(np.r_[base[rng.random(60) > 0.1], rng.integers(1, 40, rng.integers(1, 9)).astype(np.uint64)]) for _ in range(80)), key=len)
        copies, lower = rng.integers(1, 5, 80), rng.integers(0, 3, (80, 2)).astype(np.uint32)
        want = [sum(int(c) for y, c, o in zip(sets, copies, lower, strict=True) if y is not x and not (l & o).any() and 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))) for x, l in zip(sets, lower, strict=True)]
        assert any(want) and jaccard.Region(sets, 75).links(copies, lower).tolist() == want


def test_jaccard_of_nothing(spark, texts):
    assert jaccard.link(docs_frame(spark, texts).limit(0)).count() == 0
    assert [tuple(r) for r in jaccard.link(docs_frame(spark, [(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_region_keys_meet_whenever_sets_are_similar():
    """The proof of step 2, tried: of random similar pairs, all share a key."""
    rng = np.random.default_rng(4)
    tops = jaccard.class_tops(1000)
    for _ in range(1500):
        n = int(rng.integers(1, 120))
        pool = np.unique(rng.integers(0, 2**63, n + 200).astype(np.uint64))
        drop, add = int(rng.integers(0, n // 5 + 1)), int(rng.integers(0, n // 5 + 1))
        x, y = np.sort(pool[:n]), np.sort(np.r_[pool[drop:n], pool[n : n + add]])
        if not len(y):
            continue
        both = len(np.intersect1d(x, y))
        for percent in (60, 80, 85):
            if 100 * both >= percent * (len(x) + len(y) - both):
                assert len(np.intersect1d(*(np.concatenate([k for _, _, k in jaccard.region_keys(s, percent, tops)]) for s in (x, y))))


def test_region_keys_reach_classes_further_up():
    """With a low percent a similar set may lie two classes up or more: every subset that is similar by size alone."""
    rng = np.random.default_rng(11)
    tops = jaccard.class_tops(1000)
    for percent in (30, 50, 60):
        for n in range(1, 120):
            y = np.unique(rng.integers(0, 2**63, n * 100 // percent).astype(np.uint64))
            keys = [np.concatenate([k for _, _, k in jaccard.region_keys(s, percent, tops)]) for s in (np.sort(rng.permutation(y)[:n]), y)]
            assert len(np.intersect1d(*keys)), (percent, n)


# 3 and 4


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


def ids_of(tokenizer, text, end):
    return np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_words_encode_like_texts(tokenizer):
    odd = ["a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "é ́x y　z \x85q", "\x1cA\x1d b", "don't DON'T. i'M,", "x" * 200 + " " + "é" * 100, "ΣΑΣ Σ İstanbul ß", "12ab34 !!??..a. b., c,\nd", " ́́ ", "a​b c", "w.\tx,  y.", ""]
    got = tokens.encoder(tokens.default_path()).encode([t.encode() for t in odd])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


def test_words_past_the_normalizers(tokenizer):
    """Words of few letters from many alphabets, each met for the first time: none may differ from the whole tokenizer."""
    rng, encoder = np.random.default_rng(11), tokens.Encoder(tokens.default_path(), 1 << 20)
    assert encoder.direct
    some = list("abcdexyzäöüßéèñçœÀÉÑΣσςάλєѐ'.,-1½ªºǅŉſıİ·;ʹ;")
    for letters in (some, [chr(c) for c in range(0x21, 0x600)]):
        for size in rng.integers(1, 8, 5000):
            word = "".join(rng.choice(letters, size)) + " x"
            want = np.asarray(tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            assert encoder.encode([word.encode()]) == [want], word


def test_packing(spark, texts, tokenizer):
    rows = packing.pack(packing.written(packing.cut(docs_frame(spark, texts)), "pieces")).collect()
    want = Counter()
    for i, t in texts:
        ids = ids_of(tokenizer, t, 0)
        for k, a in enumerate(range(0, len(ids), 2048)):
            want[i, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) == packing.lower_bound(Counter(r.length for r in rows), 2048)
    assert packing.pack(packing.written(packing.cut(docs_frame(spark, texts).limit(0)), "pieces")).count() == 0


def best_possible(sizes, cap):
    """The least number of bins, by trying."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for room in sorted({b for b in bins if b >= sizes[i]}):
            rest = list(bins)
            rest[rest.index(room)] -= sizes[i]
            go(i + 1, rest)
        go(i + 1, [*bins, cap - sizes[i]])

    go(0, [])
    return best[0]


def test_plans_are_good():
    rng = random.Random(8)
    worse = 0
    for _ in range(150):
        cap = rng.choice([10, 20, 50])
        sizes = [rng.randint(1, cap) for _ in range(rng.randint(1, 11))]
        found = packing.plan(Counter(sizes), cap)
        used = Counter()
        for items, n in found:
            assert sum(items) <= cap and n > 0
            used.update({l: c * n for l, c in Counter(items).items()})
        assert used == Counter(sizes)
        least, bins = best_possible(sizes, cap), sum(n for _, n in found)
        assert packing.lower_bound(Counter(sizes), cap) <= least <= bins
        worse += bins > least
    assert worse == 0


def whole_documents(rows):
    """(doc_id, start, ids) from parts of documents; each part's checksum holds for the document up to its end."""
    parts = defaultdict(list)
    for r in rows:
        parts[r.start].append(r)
    for start, own in sorted(parts.items()):
        ids = b""
        for r in sorted(own, key=lambda r: r.part_start):
            assert r.part_start * 4 == len(ids)
            ids += bytes(r.ids)
            assert (r.n_tokens * 4, r.ids_crc32) == (len(ids), zlib.crc32(ids))
        yield own[0].doc_id, start, ids


@pytest.mark.parametrize("symbols", [1 << 15, 100])
def test_token_files(spark, texts, tokenizer, monkeypatch, symbols):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 3000)
    monkeypatch.setattr(token_files, "MOST_SYMBOLS", symbols)
    files = token_files.write(docs_frame(spark, texts))
    found = list(whole_documents(token_files.read(files).collect()))
    ids = [i for i, _, _ in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [start for _, start, _ in found] == np.cumsum([0, *(len(x) // 4 for _, _, x in found)])[:-1].tolist()
    assert Counter((i, x) for i, _, x in found) == Counter((i, ids_of(tokenizer, t, 2).tobytes()) for i, t in texts)
    briefly = token_files.read(files, with_ids=False).collect()
    assert Counter(map(tuple, briefly)) == Counter((i, start, len(x) // 4, zlib.crc32(x)) for i, start, x in found)
    assert token_files.read(token_files.write(docs_frame(spark, texts).limit(0))).count() == 0


def test_segments_hold_any_vocabulary():
    rng = np.random.default_rng(3)
    parts = [token_files.Part(k, rng.permutation(200_000).astype("<u4").tobytes()) for k in range(2)] + [token_files.Part(None, np.arange(49_000, dtype="<u4").tobytes())]
    found = [token_files.Segment(data) for _, data in token_files.encode_segments(parts)]
    assert all(len(s.symbols) <= token_files.MOST_SYMBOLS for s in found)
    assert b"".join(s.decode().tobytes() for s in found) == b"".join(p.ids for p in parts)
    assert sum(sum(s.last) for s in found) == 3


def test_segments_round_trip_and_notice_damage():
    rng = np.random.default_rng(0)
    for ids in ([np.asarray([7])], [np.full(100_000, 3)], [rng.integers(0, 30_000, 50_000), np.asarray([2**31])], [rng.geometric(0.01, 20_000), np.zeros(0)]):
        parts = [np.asarray(x, "<u4").tobytes() for x in ids]
        data = token_files.encode_segment([token_files.Part(d, x) for d, x in zip([None, 5], parts, strict=False)])
        s = token_files.Segment(data)
        assert s.decode().tobytes() == b"".join(parts)
        if s.blocks > 2:
            per = token_files.LANES * token_files.STEPS * 4
            assert s.decode(1, 2).tobytes() == b"".join(parts)[per : 2 * per]
    broken = bytearray(data)
    broken[-1] ^= 1
    with pytest.raises(token_files.Damaged):
        token_files.Segment(bytes(broken))


# 5


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    out, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * w[s] / total for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def test_mixing(spark, texts, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 5)
    sources = ["b", "a", None, "hot", "hot", "hot", "Z"]
    df = docs_frame(spark, texts, langs=sources, sources=sources)
    source_of = [sources[k % len(sources)] for k in range(len(texts))]
    sizes, size = Counter(), []
    for (_, t), s in zip(texts, source_of, strict=True):
        size.append(len(WORD.findall((t or "").encode())))
        sizes[s] += size[-1]
    rows = mixing.mix(df, keep=("lang",)).collect()
    want = brute_targets(sizes)
    assert Counter((r.doc_id, r.size, r.lang) for r in rows) == Counter((i, n, s) for (i, _), n, s in zip(texts, size, source_of, strict=True))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.lang] and r.target == pytest.approx(want[r.lang]) and 0 <= r.taken <= 2 * r.size
        taken[r.lang] += r.taken
        assert r.taken >= r.size * int(want[r.lang] // max(1, sizes[r.lang]))  # whole epochs first
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(df, keep=("lang",)).collect()))
    assert mixing.mix(df.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs_frame(spark, [(1, None), (2, "")])).collect()] == [0, 0]


# 6


def brute_cut(rows, least):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[a : a + least] for a in range(len(b) - least + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for a in range(len(b) - least + 1):
            if seen[b[a : a + least]] > 1:
                gone[a : a + least] = True
        gone = gone[: len(b)]
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("least, family, unit", [(400, None, None), (50, None, None), (50, 200, 300), (51, 100, 1 << 20)])
def test_repeats(spark, texts, monkeypatch, least, family, unit):
    if family:
        monkeypatch.setattr(repeats, "FAMILY_BYTES", family)
        monkeypatch.setattr(repeats, "UNIT_BYTES", unit)
    out = repeats.cut(docs_frame(spark, texts), least).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out) == brute_cut(texts, least)


def test_repeats_of_a_passage_in_many_texts(spark, monkeypatch):
    """The rows of families beyond a unit grow with the contexts, not with their windows too."""
    rng = random.Random(7)
    some = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    least, passage, ends = 120, some(330), [some(40) for _ in range(3)]
    # Ends all differ, or are shared by a part of the texts, or are cut off; twice in one text, and in equal texts.
    texts = [(i, some(rng.randint(0, 50)) + (rng.choice(ends) if i % 3 == 0 else "") + passage[rng.choice([0, 0, 0, 5, 90]) :] + (rng.choice(ends) if i % 2 else "") + some(rng.randint(0, 50))) for i in range(120)]
    texts += [(200, passage + some(9) + passage), (201, texts[3][1]), (202, texts[3][1]), (203, some(400))]
    made, written = Counter(), repeats.written

    def counted(df, label, *more):
        out = written(df, label, *more)
        made[label] += out.count()
        return out

    monkeypatch.setattr(repeats, "written", counted)
    monkeypatch.setattr(repeats, "FAMILY_BYTES", 3000)
    monkeypatch.setattr(repeats, "UNIT_BYTES", 4000)
    out = repeats.cut(docs_frame(spark, texts), least).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out) == brute_cut(texts, least)
    assert made["families"] <= 4 * made["contexts"]


def test_repeats_of_nothing_and_long_texts_in_pieces(spark, texts, monkeypatch):
    assert repeats.cut(docs_frame(spark, texts).limit(0)).count() == 0
    monkeypatch.setattr(repeats, "PIECE", 700)
    out = repeats.cut(docs_frame(spark, texts), 60).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out) == brute_cut(texts, 60)


def test_run_index_matches_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))).encode() for _ in range(rng.randint(1, 8))]
        least = rng.randint(1, 12)
        seen = Counter(s[a : a + least] for s in strings for a in range(len(s) - least + 1))
        want = [[a for a in range(len(s) - least + 1) if seen[s[a : a + least]] > 1] for s in strings]
        assert [w.tolist() for w in repeats.windows_of(strings, least)] == want


def test_cut_on_whole_characters():
    data = "aéb漢c".encode()
    for a in range(len(data)):
        for b in range(a + 1, len(data) + 1):
            (x, y), = repeats.whole_characters(data, [[a, b]])
            assert x <= a and y >= b
            (data[:x] + data[y:]).decode()


# 7 and 8


def test_quality_learns_and_scores_all(spark, words):
    rng = random.Random(9)
    good = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 80))) + "." for _ in range(300)]
    bad = [" ".join(rng.choice(words).upper() + "!!" for _ in range(rng.randint(20, 80))) if k % 2 else (rng.choice(words) + " ") * 60 for k in range(200)]
    rows = list(enumerate(good + bad))
    labels = spark.createDataFrame([(i, int(i < 300), 0, "x") for i, _ in rows] + [(None, 1, 0, "x"), (3, None, 0, "x"), (9999, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    df = docs_frame(spark, [*rows, (None, None), (None, "a b"), (700, ""), (701, "x" * 30_000), (0, good[0])])
    out = quality.score(df, quality.fit(df, labels)).withColumn("held_out", quality.held_out()).collect()
    assert len(out) == len(rows) + 5 and all(0 <= r.score <= 1 for r in out)
    test = [r for r in out if r.held_out and r.doc_id < 500]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in out if r.doc_id is not None)
    assert np.mean([(r.score >= 0.7) == (r.doc_id < 300) for r in test]) > 0.9
    one = labels.where("quality = 1")
    assert len({r.score for r in quality.score(df, quality.fit(df, one)).collect()}) == 1
    assert quality.score(df.limit(0), quality.fit(df.limit(0), labels.limit(0))).count() == 0


def test_language(spark):
    rng = random.Random(10)
    stems = {l: ["".join(rng.choice(a) for _ in range(rng.randint(2, 5))) for _ in range(80)] for l, a in (("aa", "abcdefgh"), ("bb", "mnopqrst"), ("cc", "uvwxyzéü"))}
    rows, langs = [], []
    for i in range(240):
        l = ("aa", "bb", "cc")[i % 3]
        rows.append((i, " ".join(rng.choice(stems[l]) for _ in range(rng.randint(5, 60)))))
        langs.append(l)
    rows += [(300, None), (301, ""), (302, "12 34 !!"), (None, rows[0][1]), (303, rows[1][1] * 200)]
    langs += ["aa", None, "bb", "aa", None]
    df = docs_frame(spark, rows, langs=langs)
    found = language.learn(language.learnable(df))
    out = language.classify(df, found, keep=("doc_id", "lang")).collect()
    by_id = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (300, 301, 302))
    assert by_id[303].lang_pred == "bb"
    assert np.mean([by_id[i].lang_pred == langs[i] for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]) > 0.97
    assert {r.lang_pred for r in language.classify(df, {}).collect()} == {"und"}
    assert {r.lang_pred for r in language.classify(df, found, min_margin=1.1).collect()} == {"und"}
    assert language.classify(df.limit(0), language.learn(language.learnable(df.limit(0)))).count() == 0


def test_language_of_long_texts(spark):
    """The whole text counts, not what a window holds: a short beginning in another language decides nothing."""
    rng = random.Random(12)
    stems = {l: ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(4000)] for l in ("aa", "bb")}
    say = lambda l, n: " ".join(rng.choice(stems[l]) for _ in range(n))
    found = {l: language.letters(say(l, 20_000))[: language.DICT_BYTES] for l in stems}
    rows = [(1, say("aa", 50_000) + " " + say("bb", 250_000)), (2, say("bb", 50_000) + " " + say("aa", 250_000)), (3, say("aa", 4000)), (4, say("aa", 300_000))]
    out = {r.doc_id: r for r in language.classify(docs_frame(spark, rows), found).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4)] == ["bb", "aa", "aa", "aa"]
    assert out[4].score > 0.8 * out[3].score  # the margin doesn't fall with length


# 9


def test_flac_round_trip(spark, texts):
    out = flac.digests(flac.written(flac.media(docs_frame(spark, texts)), "media")).collect()
    want = Counter()
    for i, t in texts:
        b = (t or "").encode()
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        want[i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in out) == want
    same = defaultdict(set)
    for r in out:
        same[r.payload_sha256].add((r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in same.values())
    assert flac.digests(flac.media(docs_frame(spark, texts).limit(0))).count() == 0
    blocks = flac.pcm_blocks(flac.media(docs_frame(spark, [(1, "ab" * 1500)]))).orderBy("block").collect()
    assert [(r.sample_offset, r.samples) for r in blocks] == [(0, 1024), (1024, 1024), (2048, 960)]


def test_flac_kinds_of_frames_and_damage():
    rng = np.random.default_rng(1)
    wave = (128 + 60 * np.sin(np.arange(6400) / 9)).astype(np.uint8)
    cases = [np.zeros(5000, np.uint8), np.arange(5000).astype(np.uint8), rng.integers(0, 256, 5000).astype(np.uint8), wave, (np.cumsum(rng.normal(0, 2, 9000)) % 250).astype(np.uint8), np.full(64, 255, np.uint8)]
    raw, at = np.concatenate(cases), np.r_[0, np.cumsum([len(c) for c in cases])]
    for table in (flac.TEXT, flac.PCM):
        streams = flac.encode(raw, at, table)
        assert [p for p, _ in flac.decode(streams, table)] == [c.tobytes() for c in cases]
    assert len(streams[0]) < 400 and len(streams[3]) < len(wave) / 2  # constant frames; a linear predictor
    broken = bytearray(streams[3])
    broken[-40] ^= 1
    with pytest.raises(flac.Damaged):
        flac.decode([bytes(broken)], flac.PCM)


# 10


def test_warc(spark):
    rows = [(5, "http://a/x?y#z", "<p>same</p>", "c"), (2, "http://b", "<p>same</p>", "c"), (9, None, "<p>same</p>", "c"), (1, "http://c/ü b", None, "c"), (3, "u", "", "c"), (4, "u\r\nX: y", "ünique\r\n\r\nx", "c"), (2, "http://b", "<p>same</p>", "c"), (None, "n", "<p>same</p>", "c"), (None, "n", "alone", "c"), (6, "http://long", "long " * 200_000, "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, sha string")
    files = warc.write(df)
    out = warc.captures(warc.read(files)).collect()
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = Counter()
    for i, _, h, _ in rows:
        b = (h or "").encode()
        revisit = (h or "") in first and first[h or ""] != i
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None] += 1
    assert Counter((r.metadata.page_id, r.response.payload_bytes, r.response.payload_digest, r.response.type, r.metadata.refers_to) for r in out) == want
    ids = {r.response.record_id: r.metadata.page_id for r in out if r.response.type == "response"}
    assert all(ids[r.response.refers_to_id] == r.metadata.refers_to for r in out if r.response.type == "revisit")
    assert all(r.request is not None for r in out)
    assert warc.captures(warc.read(warc.write(df.limit(0)))).count() == 0
    data = bytearray(warc.record("response", "<urn:x>", b"HTTP/1.1 200 OK\r\n\r\nabc", "t", [("WARC-Payload-Digest", "sha1:WRONG")]))
    with pytest.raises(warc.Damaged):
        list(warc.parse(bytes(data), "a", True))
    with pytest.raises(warc.Damaged):
        list(warc.parse(bytes(data[:-9]), "a", True))


def test_archives_are_read_in_linear_time(monkeypatch):
    """What inflating copies beyond the members' ends grows with the archive, not with its square."""
    blocks = [(b"%d " % i) * (20_000 if i == 700 else 5) for i in range(1500)]
    files = b"".join(warc.record("metadata", f"<urn:{i}>", b, "t", []) for i, b in enumerate(blocks))
    copied, inflater = [], zlib.decompressobj

    class Counted:
        def __init__(self, *how):
            self.inner = inflater(*how)

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def decompress(self, data):
            out = self.inner.decompress(data)
            copied.append(len(self.inner.unused_data))
            return out

    monkeypatch.setattr(warc.zlib, "decompressobj", Counted)
    found = list(warc.parse(files, "a", True))
    assert [r[1] for r in found] == [f"<urn:{i}>" for i in range(1500)]
    assert len(files) > 20 * warc.FEED and sum(copied) <= len(found) * warc.FEED
    large = warc.record("metadata", "<urn:x>", random.Random(3).randbytes(3 * warc.FEED), "t", [])
    for end in (len(large) - 1, warc.FEED, 2 * warc.FEED):
        with pytest.raises(warc.Damaged):
            list(warc.parse(large[:end], "a", True))
