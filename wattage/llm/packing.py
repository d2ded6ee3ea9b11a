"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

Pieces and gaps are range-sorted by size. In a round every piece proposes to its
successor, the smallest gap that holds it; pieces that propose to the same gap are
told apart by rank, the surplus going on to the next larger gap; gaps that won a
piece shrink and are sorted again for the next round. Rounds work down through bands
of sizes, and a piece for which no gap is large enough opens a sequence.

Pieces of one length are interchangeable, and so are gaps that came about alike, so
before a sweep both sorted lists are pre-aggregated into runs (size, number). A run
list has at most one entry per size and history: its length depends on the context
length, not on the corpus. The sweep therefore exchanges runs, and only the final
placement touches every piece, once, by its rank: no round shuffles the corpus.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from .common import stage
from .tokens import encoder

CONTEXT = 2048
TEXTS_AT_ONCE = 2_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Run(NamedTuple):
    """``count`` sequences with the same gap and fill, numbered from ``sequence``."""

    gap: int
    sequence: int
    count: int


class Placement(NamedTuple):
    """Pieces with ranks ``rank .. rank + count - 1`` go to ``sequence ..`` at ``offset``."""

    rank: int
    count: int
    sequence: int
    offset: int


def plan_runs(lengths: dict[int, int], context: int) -> list[Placement]:
    """Placements for ``lengths`` (length -> number of pieces); ranks count all pieces from the longest down."""
    rank, first = 0, {}
    for size in sorted(lengths, reverse=True):
        first[size] = rank
        rank += lengths[size]
    left = {size: n for size, n in lengths.items() if n}
    placed: list[Placement] = []
    gaps: list[Run] = []  # sorted by gap
    sequences = 0

    def put(size: int, count: int, sequence: int, offset: int) -> Run:
        placed.append(Placement(first[size], count, sequence, offset))
        first[size] += count
        left[size] -= count
        if not left[size]:
            del left[size]
        return Run(context - offset - size, sequence, count)

    def opened(size: int, count: int) -> Run:
        nonlocal sequences
        sequences += count
        return put(size, count, sequences - count, 0)

    # No two pieces longer than half the context share a sequence.
    for size in sorted((s for s in left if 2 * s > context), reverse=True):
        run = opened(size, left[size])
        if run.gap:
            gaps.append(run)
    gaps.sort()
    top = context // 2
    while left:
        band = sorted((s for s in left if 2 * s > top), reverse=True)
        if not band:
            top //= 2
            continue
        # The largest gap is too small for the longest piece: it will not grow, so sequences are opened.
        if not gaps or gaps[-1].gap < band[0]:
            size = band[0]
            bisect.insort(gaps, opened(size, -(-left[size] // (context // size))))
            continue
        # One sweep from the largest size down: gaps met on the way wait on a stack, its top is the successor.
        stack: list[Run] = []
        shrunk: list[Run] = []
        g = len(gaps) - 1
        for size in band:
            while g >= 0 and gaps[g].gap >= size:
                stack.append(gaps[g])
                g -= 1
            while stack and size in left:
                run = stack.pop()
                n = min(run.count, left[size])
                if n < run.count:
                    stack.append(Run(run.gap, run.sequence + n, run.count - n))
                after = put(size, n, run.sequence, context - run.gap)
                if after.gap:
                    shrunk.append(after)
        gaps = sorted([*gaps[: g + 1], *stack, *shrunk])
    return placed


def cut_pieces(docs: DataFrame, end_id: int, context: int = CONTEXT, tokenizer: str | None = None) -> DataFrame:
    """Encode every whole text, append ``end_id`` and cut documents longer than ``context``.

    A cut document's pieces are full but for the first. Null text is empty (its one
    piece is the end id). One row per piece; documents are not shuffled.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encode = encoder(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                n, ids = encode.encode(batch.column(1).slice(lo, TEXTS_AT_ONCE))
                doc_ids = batch.column(0).slice(lo, TEXTS_AT_ONCE)
                ids = np.insert(ids, np.cumsum(n), end_id)
                n = n + 1
                pieces = -(-n // context)
                short = n - (pieces - 1) * context  # length of the first piece, 1 .. context
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.where(piece == 0, 0, short[doc] + (piece - 1) * context)
                length = np.where(piece == 0, short[doc], context)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                begin = (np.cumsum(n) - n)[doc] + start
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(begin.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return keyed.mapInArrow(cut, PIECES)


def place(pieces: DataFrame, context: int = CONTEXT) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 .. ``context``.

    Needs columns doc_id, piece, start, length, ids_crc32 (a total order up to equal rows).
    """
    # The longest first; ranks are fixed by dense_key's checkpoint, so equal rows keep theirs.
    ranked = dense_key(pieces, ["length", "doc_id", "piece", "start", "ids_crc32"], "rank", descending=True)
    # At most ``context`` rows, whatever the corpus.
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = sorted(plan_runs(lengths, context))
    ranks = np.array([p.rank for p in plan], np.int64)
    sequence = np.array([p.sequence for p in plan], np.int64)
    offset = np.array([p.offset for p in plan], np.int64)
    table = pieces.sparkSession.sparkContext.broadcast((ranks, sequence, offset))  # bounded as the runs are

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(rank: pd.Series) -> pd.DataFrame:
        ranks, sequence, offset = table.value
        at = rank.to_numpy() - 1
        row = np.searchsorted(ranks, at, "right") - 1
        return pd.DataFrame({"sequence_id": sequence[row] + at - ranks[row], "offset": offset[row]})

    return ranked.withColumn("place", look_up("rank")).select(*pieces.columns, "place.sequence_id", "place.offset")


def pack(docs: DataFrame, end_id: int = 0, context: int = CONTEXT, tokenizer: str | None = None) -> DataFrame:
    """Pack documents into sequences of at most ``context`` ids; one row per piece.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset. Repeated documents
    are packed as often as they occur, a null doc_id stays null, an empty table gives
    no row, other columns of ``docs`` are not read.
    """
    return place(stage(cut_pieces(docs, end_id, context, tokenizer), "pieces"), context)
