"""Upsert, insert-if-absent and batch de-duplication for plain parquet tables.

Spark without a transactional table format has no MERGE on parquet, so a merge
is a full outer join on the key followed by per-column CASE expressions. With a
``bucket`` (for readings: the day of the reading) only the target rows of the
buckets the batch touches go through the join; the rest pass by a broadcast
anti-join on the small bucket set, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import dense_key
from .sizing import small_side


def dedupe_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest ``order`` values, ties broken by all other columns.
    The chosen row's values are taken as they are, NULLs too.

    ``max_by`` aggregates on the map side first, so a key repeated a million times
    in one task leaves that task as one row.
    """
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys]
    tie = [c for c in rest if c not in order]
    rank = F.struct(*[F.col(c) for c in [*order, *tie]])
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_best")
    return batch.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(
        *batch.columns
    )


def _merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    on_match: Mapping[str, Column],
    on_insert: Mapping[str, Column],
    version: str | None,
) -> DataFrame:
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = batch.select(*[F.col(c).alias(f"s__{c}") for c in batch.columns], F.lit(True).alias("_in_s"))
    cond = [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    matched = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    inserted = F.col("_in_t").isNull()
    if version is not None:
        tv, sv = F.col(f"t__{version}"), F.col(f"s__{version}") if version in batch.columns else F.lit(None)
        matched = matched & (tv.isNull() | sv.isNull() | (sv >= tv))
    out = []
    for c in target.columns:
        tc = F.col(f"t__{c}")
        sc = F.col(f"s__{c}") if c in batch.columns else F.lit(None)
        ins = on_insert.get(c, sc)
        if c == version:
            expr = F.when(inserted, ins).when(matched, F.coalesce(sc, tc)).otherwise(tc)
        elif c in keys:
            expr = F.when(inserted, sc).otherwise(tc)
        elif c in update_cols:
            expr = F.when(inserted, ins).when(matched, sc).otherwise(tc)
        elif c in on_match:
            expr = F.when(inserted, ins).when(matched, on_match[c]).otherwise(tc)
        else:
            expr = F.when(inserted, ins).otherwise(tc)
        out.append(expr.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    on_match: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    bucket: Column | None = None,
    version: str | None = None,
) -> DataFrame:
    """New state of ``target`` after merging ``batch`` on ``keys``.

    Matched rows take ``update_cols`` from the batch and the ``on_match``
    expressions; batch rows without a match are inserted (``on_insert`` columns take
    that expression, columns missing from the batch NULL); other target rows stay as they are.
    With ``version`` (a sortable column) the last writer wins: a matched row changes only if the
    batch's version is not less than the target's; an unknown version gives way, or overrides.
    The batch must be unique on ``keys`` (see ``dedupe_batch``). Running the same
    upsert twice gives the same table as running it once.
    """
    on_match = dict(on_match or {})
    on_insert = dict(on_insert or {})
    if bucket is None:
        return _merge(target, batch, keys, update_cols, on_match, on_insert, version)
    touched = small_side(batch.select(bucket.alias("_bucket")).distinct())
    tb = target.withColumn("_bucket", bucket)
    untouched = tb.join(touched, "_bucket", "left_anti").drop("_bucket")
    in_play = tb.join(touched, "_bucket", "left_semi").drop("_bucket")
    return untouched.unionByName(_merge(in_play, batch, keys, update_cols, on_match, on_insert, version))


def insert_absent(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    key_col: str | None = None,
    insert_order: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` plus the ``rows`` whose key is not in it (NOT EXISTS as a left anti join).

    With ``key_col`` the new rows get surrogate keys after the largest existing one,
    numbered in ``insert_order`` (an identity column filled in insert order).
    """
    new = rows.join(target.select(*keys), list(keys), "left_anti")
    if key_col is not None:
        top = target.agg(F.max(key_col)).first()[0] or 0
        order = list(insert_order or keys)
        new = dense_key(new, order, name="_seq").withColumn(key_col, (F.col("_seq") + F.lit(top)).cast("long"))
    return target.unionByName(new.select(*target.columns))
