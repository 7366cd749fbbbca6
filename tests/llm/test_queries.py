"""The registered queries over whole tables: against brute force on a small fixture, and by held-out accuracy."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest

from changelake.llm import packing, queries, repeats

from .test_operators import brute_counts, brute_cut, brute_links, docs_frame, ids_of, texts, tokenizer, words  # noqa: F401

SF = "/root/testdata/sf0.01"
QUERIES = queries.QUERIES


@pytest.fixture(scope="module")
def tables(spark, texts, tmp_path_factory):  # noqa: F811
    path = str(tmp_path_factory.mktemp("tables"))
    docs_frame(spark, texts, sources=["a", None, "hot"]).write.parquet(f"{path}/documents.parquet")
    return path


def test_jaccard_query(spark, tables, texts):  # noqa: F811
    got = QUERIES["op2_jaccard_components"](spark, tables).collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == brute_links(texts, 4, 85)
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in got) == brute_counts(texts, 4, 85)


def test_packing_query(spark, tables, texts, tokenizer):  # noqa: F811
    got = QUERIES["op3_best_fit_packing"](spark, tables).collect()
    want = Counter()
    for i, t in texts:
        ids = ids_of(tokenizer, t, 0)
        want.update((i, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048)))
    assert Counter(tuple(r)[:5] for r in got) == want
    assert len({r.sequence_id for r in got}) == packing.lower_bound(Counter(r.length for r in got), packing.CAP)


def test_token_query(spark, tables, texts, tokenizer):  # noqa: F811
    got = sorted(map(tuple, QUERIES["op4_token_files"](spark, tables).collect()), key=lambda r: r[1])
    ids = Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ((i, ids_of(tokenizer, t, 2)) for i, t in texts))
    assert Counter((r[0], *r[2:]) for r in got) == ids
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()


def test_repeats_query(spark, tables, texts):  # noqa: F811
    got = QUERIES["op6_repeated_spans"](spark, tables).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute_cut(texts, repeats.LEAST)
    assert all(r.n_kept == r.n_bytes - r.n_removed for r in got)
    whole = dict((i, t) for i, t in texts if i is not None and [j for j, _ in texts].count(i) == 1)
    for r in got:
        if r.doc_id in whole:
            assert r.text == (whole[r.doc_id] or "") if not r.n_removed else len(r.text.encode()) <= r.n_kept + 8


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_quality_query_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op7_quality_score"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    test = [r for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in test)
    assert len(test) > 50 and np.mean([r.predicted == labels[r.doc_id] for r in test]) > 0.93


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_language_query_on_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(got) == len(langs)
    test = [r for r in got if r.held_out and langs[r.doc_id] is not None and r.lang_pred != "und"]
    assert len(test) > 100 and np.mean([r.lang_pred == langs[r.doc_id] for r in test]) > 0.97
