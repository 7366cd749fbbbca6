"""The corpus pipeline: language identification, near-duplicate removal, repeated-span removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. See the operators for what they do with nulls, empty
and long texts, ties, repeated rows and empty tables; where a stage decides by doc_id, rows with a null doc_id stay.
Further columns may have any names, the operators' own included: they are carried along under neutral ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import jaccard, language, mixing, packing, repeats
from changelake.llm.common import BESIDE_TEXTS, documents, lean, rested, sized, written

#: Near duplicates: shingles of five words, similarity 0.8. Passages of 50 words and more are about 240 bytes.
WORDS, PERCENT, REPEAT_BYTES = 5, 80, 240
#: A document is rejected if no language beats the next by this part of its compressed size.
MIN_MARGIN = 0.005
#: The columns that stages know, and the words that a worker of the last stage keeps: few, beside a heap that has grown.
KNOWN, CACHE_WORDS = ("doc_id", "text", "lang", "source", "n_chars"), 150_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(stage: Stage) -> Stage:
    """stage, with the columns that it doesn't know under neutral names, and on executors that gave their free heap back."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rested(spark)
        inner = [c if c in KNOWN else f"__other_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inner), sf_dir).toDF(*docs.columns)

    return run


@apart
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: no letter, or a margin under MIN_MARGIN."""
    found = language.classify(docs, language.learn(language.learnable(docs)), MIN_MARGIN, tuple(c for c in docs.columns if c != "text"), with_text=True)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


@apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays; of its repeated rows (the same doc_id
    and text), one. Rows that share a doc_id but hold different texts stay or go together."""
    linked = written(jaccard.link(docs, WORDS, PERCENT), "linked")
    lost = linked.where("component_id <> doc_id").select(F.col("doc_id").alias("lost")).distinct()
    kept = docs.join(sized(lost, 16, most=BESIDE_TEXTS), F.col("doc_id") == F.col("lost"), "left_anti")
    # Rows that share a doc_id: rare, so only those are compared by their text.
    often = linked.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select(F.col("doc_id").alias("often"))
    often = written(often, "often")
    if often.isEmpty():
        return kept
    single = kept.join(sized(often, 16, most=BESIDE_TEXTS), F.col("doc_id") == F.col("often"), "left_anti")
    several = kept.join(sized(often, 16, most=BESIDE_TEXTS), F.col("doc_id") == F.col("often"), "left_semi")
    return single.unionByName(several.dropDuplicates(["doc_id", "text"]))


@apart
def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of REPEAT_BYTES bytes and more that occur elsewhere; null texts stay null."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = repeats.cut(docs.withColumn("__null", F.col("text").isNull()), REPEAT_BYTES, (*others, "__null"), characters=True)
    out = out.withColumn("text", F.when(~F.col("__null"), F.col("kept").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@apart
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; a document taken in part is cut after its last word taken."""
    key = F.xxhash64("text")
    takes = mixing.mix(docs.withColumn("__key", key), keep=("__key",))
    # Rows equal in doc_id and text share what was taken for them.
    per = takes.groupBy("doc_id", "__key").agg(F.max("size").alias("size"), F.floor(F.sum("taken") / F.count("*")).cast("long").alias("taken")).where("taken > 0")
    per = written(per.select(F.col("doc_id").alias("d"), F.col("__key").alias("k"), "size", "taken"), "takes")
    rows = docs.withColumn("__key", key).join(sized(per, 40, most=BESIDE_TEXTS), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("__key") == F.col("k")))
    whole = rows.where("taken >= size").withColumn("__n", F.explode(F.array_repeat(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))).select(*docs.columns)
    part = rows.where("taken % size > 0").withColumn("__words", F.col("taken") % F.col("size")).select(*docs.columns, "__words")
    return whole.unionByName(_first_words(part, docs))


def _first_words(part: DataFrame, docs: DataFrame) -> DataFrame:
    """The first __words words of each text. Only the one document of a source that its budget ends in comes here."""
    names = docs.columns

    def run(batches):
        import re

        import pyarrow as pa

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            texts = []
            for text, n in zip(batch.column(names.index("text")).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                end = 0
                for i, m in enumerate(word.finditer(text)):
                    if i == n:
                        break
                    end = m.end()
                texts.append(text[:end])
            cols = [pa.array(texts, pa.string()) if c == "text" else batch.column(i) for i, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    out = part.mapInArrow(lean(run), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*names) if "n_chars" in names else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    rested(spark)
    return packing.pack(written(packing.cut(docs, cache_words=CACHE_WORDS), "pieces"))


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_spans), ("mixing sources to target weights", mixed), ("best-fit packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
