"""The corpus pipeline: toxicity, near-duplicates, benchmark text, secrets, packing.

Each stage takes (spark, docs, sf_dir), where docs has the columns of documents (others
are carried along), and returns the documents that stay; ``run`` writes every result as
Parquet and reads it again, so a lost executor costs no earlier stage. The last stage
returns the packed pieces.

Decisions are joined to rows by document id and a hash of the whole text. Null ids and
texts, repeated rows and an empty table are handled by the operators; in addition:

* toxicity drops documents that score 0.7 or more (a null text never does);
* near-duplicates keeps one row of each group, and one of rows with the same id and text (the
  first by their other columns); documents without words are in no group and stay, each repeated row once;
* decontamination drops documents that hold a window of a benchmark item;
* secrets stay documents: every reported span is replaced by its kind in brackets, and
  n_chars follows the text;
* packing drops nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattage.llm.common import stage, stage_apart, table, text_hash
from wattage.llm.decontaminate import find_contamination
from wattage.llm.neardup import near_duplicates
from wattage.llm.packing import pack
from wattage.llm.secrets import find_secrets
from wattage.llm.toxicity import labelled_sample, learn_lexicon, score_toxicity
from wattage.operators.sizing import small_side

TOXIC = 0.7
SHINGLE_WORDS = 5
SIMILARITY = 80


def _keyed(docs: DataFrame) -> DataFrame:
    """(row: all columns, k1, k2): two non-null keys that identify id and text."""
    id_key = F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull())
    return docs.select(F.struct("*").alias("row"), id_key.alias("k1"), text_hash().alias("k2"))


def _keys(decisions: DataFrame, *more: Column) -> DataFrame:
    """The same keys for a decision table with doc_id and text_key."""
    return decisions.select(F.xxhash64("doc_id", F.col("doc_id").isNull()).alias("k1"), F.col("text_key").alias("k2"), *more)


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows whose keys are not in the stored decisions ``found``; while these are few, texts stay where they are."""
    gone = small_side(_keys(found), materialised=True)
    return _keyed(docs).join(gone, ["k1", "k2"], "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    lexicon = learn_lexicon(labelled_sample(docs, table(spark, sf_dir, "labels"), usable))
    # Only id, key and text pass through Python; the rows that go are found again by id and key.
    texts = docs.select("doc_id", "text", text_hash().alias("text_key"))
    found = score_toxicity(texts, lexicon, carry="text_key").filter(F.col("score") >= TOXIC)
    found = stage(found.select("doc_id", "text_key").distinct(), "toxic")
    return _without(docs, found)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def kept() -> list[DataFrame]:
        groups = near_duplicates(docs, k=SHINGLE_WORDS, threshold=SIMILARITY)
        # One (id, text) of each component, should an id have come with several texts. Ids do not name a
        # component (they may be null, or repeat); a document without words is its own (id, text).
        alone = [F.when(F.col("component").isNull(), F.col(c)).alias(f"alone_{c}") for c in ("doc_id", "text_key")]
        chosen = groups.filter("kept").select("doc_id", "text_key", "component", *alone)
        chosen = chosen.groupBy("component", "alone_doc_id", "alone_text_key").agg(F.min(F.struct("text_key", "doc_id")).alias("one"))
        return [chosen.select("one.doc_id", "one.text_key")]

    # The search's own tables are gone when the rows are dealt.
    (chosen,) = stage_apart(spark, kept, "chosen")
    # Of rows with one id and text each map task ships one, with the least of their other columns; the
    # join finds them dealt by its keys.
    rest = F.struct(F.lit(0).alias("_"), *[c for c in docs.columns if c not in ("doc_id", "text")])
    order = F.to_json(rest, {"ignoreNullFields": "false"})
    rows = _keyed(docs.withColumn("_rest", rest).withColumn("_order", order)).groupBy("k1", "k2")
    rows = rows.agg(F.first("row").alias("row"), F.min_by("row._rest", "row._order").alias("rest"))
    same = [F.col(f"row.{c}") if c in ("doc_id", "text") else F.col(f"rest.{c}") for c in docs.columns]
    return rows.join(_keys(chosen), ["k1", "k2"]).select(*same)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    found = stage(found.select("doc_id", "text_key").distinct(), "contaminated")
    return _without(docs, found)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_redacted(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "clean"])

    spans = find_secrets(docs).filter(F.size("spans") > 0).select("doc_id", "text_key", "spans").dropDuplicates(["doc_id", "text_key"])
    spans = stage(spans, "secret-spans")
    rows = _keyed(docs)
    schema = T.StructType([rows.schema["row"], T.StructField("clean", T.StringType())])
    # Only documents with a span pass through Python.
    dirty = rows.join(_keys(spans, F.col("spans")), ["k1", "k2"]).select("row", F.col("row.text").alias("text"), "spans")
    dirty = dirty.mapInArrow(redact, schema)
    changed = F.col("row").withField("text", F.col("clean"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length("clean").cast(docs.schema["n_chars"].dataType))
    clean = rows.join(_keys(spans), ["k1", "k2"], "left_anti").select("row")
    return clean.union(dirty.select(changed.alias("row"))).select("row.*")


def _redacted(text: str, spans: list[dict]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its first kind."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind']}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Learned weights, MinHash and tokens are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
