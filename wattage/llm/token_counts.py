"""Token counts for every context limit, from one exact length histogram.

Documents are aggregated by encoded length; the histogram is all that later questions
need. Sums over it from below and above answer, for any limit: how many documents and
tokens fit, what is cut, what share of documents is covered (so every quantile), and the
total after truncation. Sums run inside ranges of lengths and over the ranges' totals,
so the rows that meet in one task are one per range.

A null or empty text has length 0 (plus ``extra`` ids a document). Repeated documents count
as often as they occur. An empty table gives no row. Only the text is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .tokens import encoder

TEXTS_AT_ONCE = 2_000
#: Lengths of one range of running sums.
RANGE = 1_024


def length_histogram(docs: DataFrame, extra: int = 0, tokenizer: str | None = None) -> DataFrame:
    """(length, n_docs): documents by number of ids, ``extra`` ids added to each; stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                n = encode.lengths(batch.column(0).slice(lo, TEXTS_AT_ONCE))
                yield pa.RecordBatch.from_arrays([pa.array(n + extra, pa.int64())], names=["length"])

    lengths = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "length long")
    return stage(lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")), "length-histogram")


def totals_by_limit(histogram: DataFrame) -> DataFrame:
    """A row per length that occurs, taken as the context limit (exact for all limits up to the next one).

    context_limit, n_docs (of just that length), docs_fitting and tokens_fitting (not longer),
    docs_cut and tokens_cut (longer: how many, and the ids that truncation drops),
    truncated_total (ids left), share_fitting (of the documents).
    """
    rows = histogram.withColumn("tokens", F.col("length") * F.col("n_docs")).withColumn("_range", F.floor(F.col("length") / RANGE))
    until = (Window.unboundedPreceding, 0)
    inside = Window.partitionBy("_range").orderBy("length").rowsBetween(*until)
    ranges = rows.groupBy("_range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    across = Window.orderBy("_range").rowsBetween(*until)
    before = ranges.select(
        "_range", (F.sum("d").over(across) - F.col("d")).alias("d0"), (F.sum("t").over(across) - F.col("t")).alias("t0"),
    )
    whole = histogram.agg(F.sum("n_docs").alias("docs"), F.sum(F.col("length") * F.col("n_docs")).alias("tokens")).first()
    all_docs, all_tokens = F.lit(whole["docs"]).cast("long"), F.lit(whole["tokens"]).cast("long")
    sums = rows.select(
        "_range", "length", "n_docs", F.sum("n_docs").over(inside).alias("d1"), F.sum("tokens").over(inside).alias("t1")
    ).join(before, "_range")
    docs, tokens = F.col("d0") + F.col("d1"), F.col("t0") + F.col("t1")
    cut = all_docs - docs
    return sums.select(
        F.col("length").alias("context_limit"), "n_docs", docs.alias("docs_fitting"), tokens.alias("tokens_fitting"),
        cut.alias("docs_cut"), (all_tokens - tokens - F.col("length") * cut).alias("tokens_cut"),
        (tokens + F.col("length") * cut).alias("truncated_total"), (docs / all_docs).alias("share_fitting"),
    )


def quantiles(totals: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the smallest length that at least that share of the documents does not exceed."""
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    return totals.select("context_limit", "share_fitting", asked).filter(F.col("share_fitting") >= F.col("share")).groupBy("share").agg(F.min("context_limit").alias("length"))


def at_limits(totals: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_fitting, tokens_fitting, truncated_total) for any limits."""
    asked = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("asked")
    # Sums at the largest length that does not exceed the limit; none: nothing fits.
    below = totals.select(asked, "context_limit", "docs_fitting", "tokens_fitting", "docs_cut")
    fits = F.col("context_limit") <= F.col("asked")
    best = below.groupBy("asked").agg(
        F.max(F.when(fits, F.struct("context_limit", "docs_fitting", "tokens_fitting", "docs_cut"))).alias("b"),
        F.max(F.col("docs_fitting") + F.col("docs_cut")).alias("all_docs"),
    )
    cut = F.coalesce("b.docs_cut", "all_docs")
    zero = lambda c: F.coalesce(F.col(f"b.{c}"), F.lit(0)).cast("long")
    return best.select(
        F.col("asked").alias("context_limit"), zero("docs_fitting").alias("docs_fitting"), zero("tokens_fitting").alias("tokens_fitting"),
        (zero("tokens_fitting") + F.col("asked") * cut).alias("truncated_total"),
    )
