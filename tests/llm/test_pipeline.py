"""The pipeline's stages, each on its own input: brute force where its decisions are exact, and odd rows through all of them."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from changelake.llm import language, mixing, packing, queries, repeats, tokens

from .test_operators import WORD, brute_cut, brute_links, brute_targets, docs_frame, texts, words  # noqa: F401

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def staged(spark, df, name, tmp_path):
    path = f"{tmp_path}/{name.replace(' ', '-')}"
    STAGES[name](spark, df, "").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def documents(spark, texts):  # noqa: F811
    return docs_frame(spark, texts, langs=["en", "fr", None, "en"], sources=["a", None, "hot", "hot"])


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "suffix-array dedup", "mixing sources to target weights", "best-fit packing"]


def test_language_stage(spark, documents, tmp_path):
    out = staged(spark, documents, "language ID", tmp_path)
    assert out.columns == documents.columns
    found = language.classify(documents, language.learn(language.learnable(documents)), corpus_pipeline.MIN_MARGIN, keep=("doc_id", "text")).collect()
    assert Counter(texts_of(out)) == Counter((r.doc_id, r.text) for r in found if r.lang_pred != "und")
    assert staged(spark, documents.limit(0), "language ID", tmp_path / "none").count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_language_stage_keeps_clean_long_texts(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    by_lang = {}
    for r in docs.where(language.held_out()).orderBy("doc_id").collect():
        by_lang.setdefault(r.lang, []).append(r.text)
    assert len(by_lang) > 2
    joined = [(-k - 1, " ".join(t * (3_000_000 // sum(map(len, t)) + 1)), None) for k, (_, t) in enumerate(sorted(by_lang.items()))]
    out = staged(spark, docs.unionByName(spark.createDataFrame(joined, docs.schema)), "language ID", tmp_path)
    assert {r.doc_id for r in out.where("doc_id < 0").collect()} == {i for i, _, _ in joined}


def test_near_duplicate_stage(spark, documents, texts, tmp_path):  # noqa: F811
    out = staged(spark, documents, "n-gram Jaccard join", tmp_path)
    assert out.columns == documents.columns
    linked = brute_links(texts, corpus_pipeline.WORDS, corpus_pipeline.PERCENT)
    want = Counter({i: 1 for i, _, c in linked if i is not None and i == c} | {None: sum(i is None for i, _ in texts)})
    assert Counter(i for i, _ in texts_of(out)) == want
    assert staged(spark, documents.limit(0), "n-gram Jaccard join", tmp_path / "none").count() == 0


def test_near_duplicate_stage_keeps_all_texts_of_a_doc_id(spark, tmp_path):
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (1, "one two three four five six seven"), (1, "alpha beta gamma delta epsilon zeta"), (2, "red green blue black white grey")]
    out = staged(spark, docs_frame(spark, rows), "n-gram Jaccard join", tmp_path)
    assert Counter(texts_of(out)) == Counter(set(rows))


def test_repeats_stage(spark, documents, texts, tmp_path):  # noqa: F811
    out = staged(spark, documents, "suffix-array dedup", tmp_path)
    assert out.columns == documents.columns
    lengths = Counter()
    for (i, size, gone, _, _), n in brute_cut(texts, corpus_pipeline.REPEAT_BYTES).items():
        lengths[i, size - gone] += n
    ascii_only = {i for i, t in texts if t is None or t.isascii()}
    got = Counter((i, len((t or "").encode())) for i, t in texts_of(out) if i in ascii_only)
    assert got == Counter({k: n for k, n in lengths.items() if k[0] in ascii_only})
    assert out.where("text IS NULL").count() == documents.where("text IS NULL").count()
    assert out.where("n_chars <> length(text)").count() == 0
    assert staged(spark, documents.limit(0), "suffix-array dedup", tmp_path / "none").count() == 0


def test_mixing_stage(spark, documents, tmp_path):
    out = staged(spark, documents, "mixing sources to target weights", tmp_path)
    assert out.columns == documents.columns
    size = lambda t: len(WORD.findall((t or "").encode()))
    sizes, got = Counter(), Counter()
    for r in documents.collect():
        sizes[r.source] += size(r.text)
    for r in out.collect():
        got[r.source] += size(r.text)
        assert r.n_chars == len(r.text)
    want = brute_targets(sizes)
    assert all(abs(got[s] - want[s]) <= 2 for s in sizes)
    assert staged(spark, documents.limit(0), "mixing sources to target weights", tmp_path / "none").count() == 0


def test_stages_take_any_other_columns(spark, texts, tmp_path):  # noqa: F811
    odd = ["d", "k", "size", "taken", "lost", "often", "__null", "kept", "n_bytes", "spans", "__key", "__n", "__words", "score", "lang_pred", "target", "tkey", "rep", "__other_3"]
    docs = docs_frame(spark, [(i, t) for i, t in texts if t is None or len(t) < 2000], sources=["a", None, "hot"]).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.selectExpr("*", *[f"'{c}' AS `{c}`" for c in odd])
    for name in list(STAGES)[:-1]:
        out = staged(spark, docs, name, tmp_path / "odd")
        assert out.columns == docs.columns
        assert out.count() and {tuple(r) for r in out.select(*odd).distinct().collect()} == {tuple(odd)}
    assert staged(spark, docs, "best-fit packing", tmp_path / "odd").count() >= docs.count()


def test_packing_stage(spark, documents, texts, tmp_path):  # noqa: F811
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(tokens.default_path()), staged(spark, documents, "best-fit packing", tmp_path)
    want = Counter()
    for i, t in texts:
        ids = np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        want.update((i, a, zlib.crc32(ids[a : a + 2048].tobytes())) for a in range(0, len(ids), 2048))
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in out.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({r.sequence_id for r in rows}) >= sum(r.length for r in rows) / packing.CAP
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and len(queries.QUERIES) == 10
    assert mixing.SQL and repeats.LEAST == 400
