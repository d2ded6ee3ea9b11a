"""SimHash near-duplicates by anchor-point covering.

A fingerprint's bit is 1 if it is set in over half of the text's shingle hashes; two
fingerprints link at ``MOST`` or fewer differing bits. Instead of comparing all pairs:

1. Anchors are the words of a covering code: 64 bits are cut into three blocks of at most 23
   bits, each under the perfect binary Golay code (4,096 words, covering radius 3), so an
   anchor is a triple of code words and every fingerprint lies within radius 3 of one in each block.
2. Every distinct fingerprint is replicated to all anchors within radius + d, d differing bits
   beyond the blocks' radii. d need not be the whole threshold: two fingerprints 3 bits apart
   have a point one bit from one and two bits from the other, and that point's anchor is within
   radius + 2 of both. So d = 2 loses no link, and some 119 copies replace 769.
3. Copies are range-sorted by (anchor, fingerprint); each task streams its anchors and compares
   the fingerprints of one anchor in place. Only links leave an anchor, at most one less than
   its fingerprints (a spanning forest by breadth-first search), never all pairs.
4. An anchor that holds more than ``BLOCK`` fingerprints, or whose rows may go on in another task
   (a task's first and last), is cut into blocks, and pairs of blocks are compared in tasks of
   their own. A hot anchor is thus spread by range and by tile; nothing is left out.
5. Components over the links, then the smallest doc_id of each.

Exact copies collapse to one fingerprint first. A text without words has fingerprint zero and is
linked like any other. A null doc_id takes part but never names a component unless it has no other
(then null). Repeated rows each get a row; an empty table gives none; other columns are not read.
Long texts are hashed in pieces, whole.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage
from .neardup import components

SHINGLE = 3
SEED = 42
MOST = 3  # differing bits of a link
#: Fingerprints of an anchor compared at once.
BLOCK = 8_192
TEXTS_AT_ONCE = 512
#: Bytes of a text split into words at once.
PIECE = 4_000_000
#: Fingerprints replicated at once.
FINGERPRINTS_AT_ONCE = 4_096

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BITS = np.arange(64, dtype=np.uint64)


def _word_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; pieces end at white space."""
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + PIECE) if at + PIECE < len(raw) else None
        end = cut.start() if cut else len(raw)
        yield raw[at:end].split()
        at = end


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: len(words) - size + 1].tolist()
    ends = (ends - 1)[size - 1 :].tolist()
    return np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint; words are runs between ASCII white space, A-Z lower-cased.

    Each shingle counts as often as it occurs; fewer words than ``k`` are one shingle, none give 0.
    """
    raw = text.encode("utf-8", "surrogatepass").lower() if text else b""
    counts, n, carry, seen = np.zeros(64, np.int64), 0, [], 0
    for words in _word_lists(raw):
        seen += len(words)
        words = carry + words
        if len(words) >= k:
            h = _hashes(words, k)
            n += len(h)
            for lo in range(0, len(h), 65_536):
                part = h[lo : lo + 65_536].astype("<u8")
                counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            words = words[len(words) - k + 1 :]
        carry = words
    if 0 < seen < k:
        return int(_hashes(carry, len(carry))[0])
    return int(((2 * counts > n).astype(np.uint64) << _BITS).sum(dtype=np.uint64))


def _sign(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS_AT_ONCE):
            prints = np.array([fingerprint(t, k) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return sign


class Anchors:
    """Code words near a 64-bit point, for three blocks under the Golay code of length 23.

    The code is cyclic with generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1: a block's remainder
    by it (syndrome) tells all error patterns that lead to a code word, and a code word's upper 12
    bits name it. Bits that the last block lacks are zero.
    """

    LENGTH, CHECK, RADIUS = 23, 11, 3
    GENERATOR = 0b110001110101
    SHIFTS = (0, 23, 46)

    def __init__(self, most: int = MOST) -> None:
        self.spread = (most + 1) // 2
        remainder, x = [], 1
        for _ in range(self.LENGTH):
            remainder.append(x)
            x <<= 1
            if x >> self.CHECK:
                x ^= self.GENERATOR
        self.low, self.high = np.zeros(4096, np.int64), np.zeros(2048, np.int64)
        for i in range(12):
            self.low[1 << i : 2 << i] = self.low[: 1 << i] ^ remainder[i]
        for i in range(11):
            self.high[1 << i : 2 << i] = self.high[: 1 << i] ^ remainder[12 + i]
        # Error patterns of each weight class (0: within the radius, 1: one beyond, ...) by syndrome.
        self.patterns, self.first, self.count = [], [], []
        weight = 0
        for extra in range(self.spread + 1):
            found = []
            while weight <= self.RADIUS + extra:
                found += [sum(1 << i for i in bits) for bits in itertools.combinations(range(self.LENGTH), weight)]
                weight += 1
            found = np.array(found, np.int64)
            syndrome = self._syndrome(found)
            order = np.argsort(syndrome, kind="stable")
            self.patterns.append(found[order])
            self.count.append(np.bincount(syndrome, minlength=1 << self.CHECK))
            self.first.append(np.cumsum(self.count[-1]) - self.count[-1])

    def _syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & 4095] ^ self.high[words >> 12]

    def near(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``points``, anchor) of every copy."""
        mask = np.uint64((1 << self.LENGTH) - 1)
        blocks = [((points >> np.uint64(s)) & mask).astype(np.int64) for s in self.SHIFTS]
        syndromes = [self._syndrome(b) for b in blocks]
        index, anchors = [], []
        for extra in itertools.product(range(self.spread + 1), repeat=len(blocks)):
            if sum(extra) > self.spread:
                continue
            sizes = [self.count[e][s] for e, s in zip(extra, syndromes)]
            copies = np.prod(sizes, axis=0)
            of = np.repeat(np.arange(len(points)), copies)
            if not len(of):
                continue
            turn = np.arange(len(of)) - np.repeat(np.cumsum(copies) - copies, copies)
            anchor = np.zeros(len(of), np.int64)
            for e, block, syndrome, size in zip(extra, blocks, syndromes, sizes):
                turn, pick = np.divmod(turn, size[of])
                word = block[of] ^ self.patterns[e][self.first[e][syndrome[of]] + pick]
                anchor = (anchor << 12) | (word >> self.CHECK)
            index.append(of)
            anchors.append(anchor)
        return np.concatenate(index) if index else np.zeros(0, np.int64), np.concatenate(anchors) if anchors else np.zeros(0, np.int64)


def _replicate(most: int):
    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(most)
        for batch in slices(batches, FINGERPRINTS_AT_ONCE):
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            index, anchor = anchors.near(prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(prints[index])], names=["anchor", "fp"])

    return replicate


def spanning_links(prints: np.ndarray, most: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (positions) that join what is reachable at ``most`` bits a step; with ``side`` only between unlike sides."""
    out: list[tuple[int, int]] = []
    waiting = np.arange(len(prints))
    while len(waiting) > 1:
        frontier, waiting = [int(waiting[0])], waiting[1:]
        while frontier and len(waiting):
            p = frontier.pop()
            close = np.bitwise_count(prints[waiting] ^ prints[p]) <= most
            if side is not None:
                close &= side[waiting] != side[p]
            if close.any():
                hit = waiting[close].tolist()
                out += [(p, q) for q in hit]
                frontier += hit
                waiting = waiting[~close]
    return out


FOUND = "a long, b long, anchor long, block long, members binary"
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("anchor", pa.int64()), ("block", pa.int64()), ("members", pa.binary())])


def _link_rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), none, none, pa.nulls(len(a), pa.binary())], schema=_FOUND)


def _compare(most: int, block: int):
    """Links inside the anchors of a task's sorted rows, and blocks of those to be compared elsewhere."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = itertools.count(TaskContext.get().partitionId() << 33)

        def blocks(anchor: int, prints: np.ndarray) -> pa.RecordBatch:
            rows = [prints[lo : lo + block].tobytes() for lo in range(0, len(prints), block)]
            none = pa.nulls(len(rows), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, pa.array([anchor] * len(rows), pa.int64()), pa.array([next(names) for _ in rows], pa.int64()), pa.array(rows, pa.binary())], schema=_FOUND
            )

        # The anchor that the next batch may go on with, its rows so far, and whether it is cut into blocks.
        held: tuple[int, list[np.ndarray], bool] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column(0).to_numpy(zero_copy_only=False)
            prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero(np.diff(anchor)) + 1
            if held is None:
                held = (int(anchor[0]), [], True)  # a task's first anchor may have begun in another
            starts = np.r_[0, cuts]
            ends = np.r_[cuts, len(anchor)]
            links_a, links_b = [], []
            if held[0] == anchor[0]:
                held[1].append(prints[: ends[0]])
                starts, ends = starts[1:], ends[1:]
            if len(starts):
                # Anchors that begin and end in this batch: single rows have no partner, pairs are compared at once.
                yield from _close(held, block, blocks, most)
                size = (ends - starts)[:-1]
                two = starts[:-1][size == 2]
                p, q = prints[two], prints[two + 1]
                near = np.bitwise_count(p ^ q) <= most
                links_a.append(p[near]), links_b.append(q[near])
                for i in np.flatnonzero(size > 2):
                    lo, hi = int(starts[i]), int(ends[i])
                    if hi - lo > block:
                        yield blocks(int(anchor[lo]), prints[lo:hi])
                        continue
                    found = np.array(spanning_links(prints[lo:hi], most), np.int64).reshape(-1, 2)
                    links_a.append(prints[lo:hi][found[:, 0]]), links_b.append(prints[lo:hi][found[:, 1]])
                held = (int(anchor[starts[-1]]), [prints[starts[-1] :]], False)
            elif sum(map(len, held[1])) > block:  # keep no more than a block in memory
                yield blocks(held[0], np.concatenate(held[1]))
                held = (held[0], [], True)
            if links_a:
                yield _link_rows(np.concatenate(links_a), np.concatenate(links_b))
        if held is not None and held[1]:  # a task's last anchor may go on in another
            yield blocks(held[0], np.concatenate(held[1]))

    return compare


def _close(held, block: int, blocks, most: int) -> Iterator[pa.RecordBatch]:
    """What an anchor that has ended in its task gives."""
    anchor, parts, cut = held
    if not parts:
        return
    prints = np.concatenate(parts)
    if cut or len(prints) > block:
        yield blocks(anchor, prints)
        return
    found = np.array(spanning_links(prints, most), np.int64).reshape(-1, 2)
    yield _link_rows(prints[found[:, 0]], prints[found[:, 1]])


def _tiles(most: int):
    """Links inside one block, or between two."""

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                a = np.frombuffer(x.as_buffer(), np.uint64)
                if y.is_valid:
                    b = np.frombuffer(y.as_buffer(), np.uint64)
                    prints, side = np.concatenate([a, b]), np.r_[np.zeros(len(a), bool), np.ones(len(b), bool)]
                else:
                    prints, side = a, None
                found = np.array(spanning_links(prints, most, side), np.int64).reshape(-1, 2)
                yield _link_rows(prints[found[:, 0]], prints[found[:, 1]]).select(["a", "b"])

    return tiles


def near_links(prints: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """Links (a, b: long) that join all distinct fingerprints (column fp: long) ``most`` or fewer bits apart."""
    copies = prints.select("fp").mapInArrow(_replicate(most), "anchor long, fp long")
    copies = copies.repartitionByRange("anchor", "fp").sortWithinPartitions("anchor", "fp")
    found = stage(copies.mapInArrow(_compare(most, block), FOUND), "anchor-links")
    cut = found.filter("anchor is not null")
    left = cut.select("anchor", "block", "members")
    right = cut.select("anchor", F.col("block").alias("other"), F.col("members").alias("others"))
    pairs = left.join(right, "anchor").filter("block < other").select("members", "others")
    alone = left.select("members", F.lit(None).cast("binary").alias("others"))
    # Blocks are large: a few in an Arrow batch.
    tiled = alone.union(pairs).repartition(F.rand(7)).mapInArrow(_tiles(most), "a long, b long")
    return found.filter("anchor is null").select("a", "b").union(tiled).distinct()


def simhash_groups(docs: DataFrame, k: int = SHINGLE, most: int = MOST) -> DataFrame:
    """One row per document row: doc_id, fp (signed long), fingerprint (16 hex digits), component_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(texts.mapInArrow(_sign(k), "doc_id long, fp long"), "fingerprints")
    prints = stage(signed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    comps = components(stage(near_links(prints, most), "near-links"))
    comps = prints.join(comps.select(F.col("node").alias("fp"), "comp"), "fp", "left").select("fp", "first", F.coalesce("comp", "fp").alias("comp"))
    names = comps.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = comps.join(names, "comp").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return signed.join(named, "fp").select("doc_id", "fp", digits.alias("fingerprint"), "component_id")
