"""Language identification by compression: a text belongs to the language whose raw-content dictionary shrinks it most.

For each language of the learnable rows a bounded sample (SAMPLE_DOCS documents, DICT_BYTES bytes) becomes a zstandard
raw-content dictionary; all dictionaries together are bounded by ALL_BYTES. Every whole text is compressed with each dictionary, in blocks of BLOCK_BYTES that each start from
the fresh dictionary: one stream would leave the dictionary behind its window, and the rest of a long text would speak for no
language. The sizes are summed over all blocks; the smallest sum wins, ties go to the language with more learnable documents.
The score is the winner's margin over the next language; classify() rejects margins under
min_margin.

Defined results: null text, empty text and text without a letter are `und` with score 0; a table without learnable
rows gives `und` for all; null doc_id is never learned from and never held out; repeated rows each get a row; only
the columns doc_id, text and lang are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, lean, sized, tune

SAMPLE_DOCS = 160
DICT_BYTES = 96 << 10
#: All dictionaries together; with so many languages that it would be more, each is smaller.
ALL_BYTES = 16 << 20
#: Matches of 4 bytes count, which short words need; the window holds a dictionary and a block with room to spare.
MIN_MATCH, WINDOW_LOG, TABLE_LOG, SEARCH_LOG = 4, 18, 17, 3
BLOCK_BYTES = 32 << 10
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """What is compressed: lower-case words with one space between, so that mark-up and numbers speak for no language."""
    return OTHER.sub(" ", text.lower()).encode()


def held_out(part: int = 1, of: int = 3):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == part, F.lit(False))


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """Dictionaries by language, from at most SAMPLE_DOCS documents each. A language's documents are thinned by a hash of
    their ids, never by position, and only the thinned ones are sorted. The commonest language comes first."""
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / (2 * SAMPLE_DOCS))).cast("long")
    order = F.xxhash64(F.col("doc_id"))
    thin = labelled.join(sized(counts, 32), "lang").where(F.pmod(order, step) == 0)
    # The smallest hashes of a thinned language; long documents after short ones, so that the sample stays small.
    thin = thin.select("lang", F.struct((F.octet_length("text") > 8192).alias("late"), order.alias("o"), "doc_id", "text").alias("d"))
    best = thin.groupBy("lang", F.pmod(F.xxhash64("d.doc_id"), F.lit(8)).alias("s")).agg(F.slice(F.array_sort(F.collect_list("d")), 1, SAMPLE_DOCS // 8).alias("ds"))
    found: dict[str, list] = {}
    often = {r.lang: r.n for r in counts.collect()}  # one row a language
    room = min(DICT_BYTES, ALL_BYTES // max(1, len(often)))
    for r in best.select("lang", F.explode("ds").alias("d")).select("lang", "d.late", "d.o", "d.text").collect():
        found.setdefault(r.lang, []).append((r.late, r.o, r.text))
    out = {}
    for lang, docs in sorted(found.items(), key=lambda f: (-often[f[0]], f[0])):
        data, parts = 0, []
        for _, _, text in sorted(docs, key=lambda d: d[:2]):
            if data >= room:
                break
            parts.append(letters(text))
            data += len(parts[-1])
        out[lang] = b" ".join(parts)[-room:]
    return out


def classify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float | None = None, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """The columns of keep (and the text), lang_pred and score; with min_margin, texts whose margin is narrower become `und`."""
    tune(docs.sparkSession)
    schema = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", text string" * with_text + ", lang_pred string, score double"

    def run(batches):
        import pyarrow as pa
        import zstandard as z

        langs, packers = list(dictionaries), []
        params = z.ZstdCompressionParameters(strategy=z.STRATEGY_LAZY, min_match=MIN_MATCH, window_log=WINDOW_LOG, hash_log=TABLE_LOG, chain_log=TABLE_LOG, search_log=SEARCH_LOG, write_checksum=False, write_content_size=False, write_dict_id=False)
        for lang in langs:
            d = z.ZstdCompressionDict(dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            packers.append(z.ZstdCompressor(dict_data=d, compression_params=params))
        for batch in batches:
            preds, scores = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                if text is None or not langs or not LETTER.search(text):
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                data = letters(text)
                blocks = [data[a : a + BLOCK_BYTES] for a in range(0, len(data), BLOCK_BYTES)]
                sizes = [sum(len(p.compress(b)) for b in blocks) for p in packers]
                best = min(sizes)
                second = min((s for i, s in enumerate(sizes) if i != sizes.index(best)), default=2 * best)
                margin = min(1.0, (second - best) / second)
                preds.append(UNKNOWN if min_margin is not None and margin < min_margin else langs[sizes.index(best)])
                scores.append(margin)
            kept = [batch.column(i) for i in range(len(keep) + with_text)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=[*keep, *["text"] * with_text, "lang_pred", "score"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(lean(run), fields)


def learnable(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = classify(docs, learn(learnable(docs)))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
