"""Cross-tokenizer alignment with inverted pair bitmaps.

Each text, with a space before it, is encoded by a byte-level BPE (A) and by a piece BPE (B,
which puts the space there itself). Byte offsets where a token of A and one of B both end cut
the tokens into groups; the two tokens that end there are a link.

1. One pass encodes whole texts and numbers documents inside containers (a task's consecutive
   documents, at most ``CONTAINER``).
2. Inverted pair bitmaps: for each pair of ids a container holds a bitmap of the documents with a
   link of the pair, and multiplicity planes: plane k is the bitmap of documents whose number of
   links less one has bit k set. Bitmaps are compressed: positions where few bits are set, else plain
   bits. They are written once, beside the documents' own rows.
3. A pair's bitmaps of slices of a container are OR-merged as it closes. Containers hold different
   documents, so counts add over them: documents by the popcount of the bitmap, links by that plus
   2^k times the popcount of each plane. A hot pair is one small row per container, pre-aggregated
   before the shuffle.
4. Postings return scores: bitmaps meet their pair's counts, go back to their container and
   add the pair's score, times the plane's weight, to each document whose bit is set.

Texts are cut at single spaces: neither tokenizer joins across one (the piece vocabulary is looked
through for pieces that would), so each distinct chunk is encoded and aligned once and remembered in
a bounded cache. Texts with runs of white space, white space outside ASCII or at an end, or with a
chunk that B does not give back byte for byte, are encoded whole.

Null and empty texts, and texts that B does not give back, have no tokens: zeros and ''. Null or
repeated ids are kept, each row on its own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import small_side
from .common import stage
from .tokens import _WIDE_SPACE, _byte_decoder, public_tokenizer

#: Documents of a container; a container also closes after ``CONTAINER_LINKS`` links.
CONTAINER = 4_096
CONTAINER_LINKS = 3_000_000
#: Characters and texts aligned at once.
SLICE_CHARS = 2_000_000
SLICE_TEXTS = 1_024
#: Chunks remembered by a worker, in two generations.
CACHE_ENTRIES = 400_000
#: Unseen chunks encoded as one text.
CHUNKS_AT_ONCE = 4_096
#: A container's bitmap as plain bits.
PLAIN = CONTAINER // 8

# A run of white space, white space at an end, or white space that is not ASCII.
_SPACE = "[\\x20\\t-\\r]"
_ODD = f"{_SPACE}\\x20|\\x20{_SPACE}|\\A{_SPACE}|{_SPACE}\\z|{_WIDE_SPACE}"


class Chunk(NamedTuple):
    """The alignment of a chunk: numbers of tokens and groups, the groups as text (each ended by ``;``), links (packed pairs)."""

    a: int
    b: int
    n: int
    groups: str
    links: bytes


def pack_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b.astype(np.int64)


class Aligner:
    def __init__(self, path_a: str | None = None, path_b: str | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a or public_tokenizer("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizer("piece_bpe_32k.model"))
        stand_in = _byte_decoder()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            plain = all(c in stand_in for c in token)
            self.bytes_a[i] = bytes(stand_in[c] for c in token) if plain else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Each id as text, with what follows it inside a group and at the group's end.
        self.text_a = [np.array([f"{i}{end}" for i in range(len(self.bytes_a))], object) for end in ",|"]
        self.text_b = [np.array([f"{i}{end}" for i in range(len(self.bytes_b))], object) for end in ",;"]
        # A piece that goes on after a space would join chunks; then no text may be cut.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.young: dict[str, Chunk | None] = {}
        self.old: dict[str, Chunk | None] = {}

    def _align(self, text: str, ends: np.ndarray | None = None) -> list[Chunk] | None:
        """The alignments of the parts of ``text`` (a space goes before it) that end at the byte offsets ``ends``.

        None if a tokenizer does not give the text back, or a part does not end where tokens of both end.
        """
        raw = (" " + text).encode("utf-8", "surrogatepass")
        a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text), np.int64)
        if b"".join([self.bytes_b[i] for i in b.tolist()]) != raw or b"".join([self.bytes_a[i] for i in a.tolist()]) != raw:
            return None
        common, at_a, at_b = np.intersect1d(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), assume_unique=True, return_indices=True)
        last = np.searchsorted(common, [len(raw)] if ends is None else ends)
        if ends is not None and (common[last] != ends).any():
            return None
        # Tokens in the order of the text of groups: A's of a group, then B's.
        upto_a, upto_b = at_a + 1, at_b + 1
        group_a = np.repeat(np.arange(len(common)), np.diff(upto_a, prepend=0))
        group_b = np.repeat(np.arange(len(common)), np.diff(upto_b, prepend=0))
        words_a, words_b = self.text_a[0][a], self.text_b[0][b]
        words_a[at_a], words_b[at_b] = self.text_a[1][a[at_a]], self.text_b[1][b[at_b]]
        words = np.empty(len(a) + len(b), object)
        words[np.arange(len(a)) + np.r_[0, upto_b[:-1]][group_a]] = words_a
        words[np.arange(len(b)) + upto_a[group_b]] = words_b
        words, links = words.tolist(), pack_pair(a[at_a], b[at_b]).tobytes()
        out, p, q, g = [], 0, 0, 0
        for i, j, h in zip(upto_a[last].tolist(), upto_b[last].tolist(), (last + 1).tolist()):
            out.append(Chunk(i - p, j - q, h - g, "".join(words[p + q : i + j]), links[8 * g : 8 * h]))
            p, q, g = i, j, h
        return out

    def _learn(self, words: list[str]) -> None:
        """Align unseen chunks, many as one text."""
        for lo in range(0, len(words), CHUNKS_AT_ONCE):
            some = words[lo : lo + CHUNKS_AT_ONCE]
            sizes = pc.binary_length(pa.array(some, pa.large_string())).to_numpy()
            found = self._align(" ".join(some), np.cumsum(sizes + 1))
            if found is None:  # one of them is not given back
                found = [(self._align(w) or [None])[0] for w in some]
            self.young.update(zip(some, found))

    def _chunks(self, words: list[str]) -> list[Chunk | None]:
        """The alignments of distinct words, each with a space before it."""
        young, old = self.young, self.old
        new = []
        for w in words:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
        if len(young) + len(new) > CACHE_ENTRIES // 2:
            known = {w: young[w] for w in words if w in young}
            self.old, self.young = young, known
        if new:
            self._learn(new)
        return [self.young[w] for w in words]

    def align(self, texts: list[str | None]) -> tuple[list[tuple[int, int, int, str]], np.ndarray, np.ndarray]:
        """For each text (tokens of A, of B, groups, digest of the groups); (text, pair) of every link, one after another."""
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _ODD).to_pylist()
        plain = [i for i, t in enumerate(texts) if t and self.cuts and not odd[i]]
        rows: list[tuple[int, int, int, str]] = [(0, 0, 0, "")] * len(texts)
        owner, links = [], []
        whole = sorted({i for i, t in enumerate(texts) if t} - set(plain))
        if plain:
            lists = pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
            offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            coded = lists.flatten().dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            chunks = self._chunks(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            bad = np.array([c is None for c in chunks])
            sizes = np.array([(0, 0, 0) if c is None else c[:3] for c in chunks], np.int64).reshape(-1, 3)
            texts_of = [None if c is None else c.groups for c in chunks]
            totals = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(sizes[code], axis=0)])
            totals = totals[offsets[1:]] - totals[offsets[:-1]]
            spoilt = np.concatenate([[0], np.cumsum(bad[code])])
            spoilt = spoilt[offsets[1:]] > spoilt[offsets[:-1]]
            codes = code.tolist()
            values = np.frombuffer(b"".join([c.links for c in chunks if c is not None]), np.int64)
            size = sizes[:, 2]
            begin = np.cumsum(size) - size
            for j, i in enumerate(plain):
                if spoilt[j]:
                    whole.append(i)
                    continue
                lo, hi = int(offsets[j]), int(offsets[j + 1])
                rows[i] = (*totals[j].tolist(), _digest("".join([texts_of[c] for c in codes[lo:hi]])))
            n = size[code]
            end = np.cumsum(n)
            take = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(begin[code] - (end - n), n)
            of = np.repeat(np.repeat(np.arange(len(plain)), np.diff(offsets)), n)
            good = ~spoilt[of]
            owner.append(np.array(plain, np.int64)[of[good]])
            links.append(values[take[good]])
        for i in whole:
            for found in self._align(texts[i]) or []:
                rows[i] = (found.a, found.b, found.n, _digest(found.groups))
                owner.append(np.full(found.n, i, np.int64))
                links.append(np.frombuffer(found.links, np.int64))
        none = np.zeros(0, np.int64)
        return rows, np.concatenate(owner or [none]), np.concatenate(links or [none])


def _digest(groups: str) -> str:
    return hashlib.sha256(groups[:-1].encode()).hexdigest()


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(path_a: str | None, path_b: str | None) -> Aligner:
    """The aligner of this worker process."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


# --- bitmaps


def bitmaps(slots: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes]]]:
    """Compressed bitmaps of postings grouped by pair (``starts``: where a pair begins; slots ascend inside it).

    Yields (plane, index of the pair, popcount, bitmaps); plane -1 is the document bitmap.
    """
    pair = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(slots)]))
    plane, more = -1, counts - 1
    chosen = np.arange(len(slots))
    while True:
        if len(chosen):
            owner = pair[chosen]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            bits = np.diff(np.r_[first, len(chosen)])
            at = slots[chosen].astype("<u2")
            raw = at.tobytes()
            out = [raw[2 * f : 2 * (f + n)] for f, n in zip(first.tolist(), bits.tolist())]
            for i in np.flatnonzero(2 * bits >= PLAIN):
                flags = np.zeros(CONTAINER, bool)
                flags[at[first[i] : first[i] + bits[i]]] = True
                out[i] = np.packbits(flags, bitorder="little").tobytes()
            yield plane, owner[first], bits, out
        plane += 1
        if not (more >> plane).any():
            return
        chosen = np.flatnonzero((more >> plane) & 1)


def positions(bitmap: bytes) -> np.ndarray:
    """The set bits of a compressed bitmap."""
    if len(bitmap) == PLAIN:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))
    return np.frombuffer(bitmap, "<u2").astype(np.int64)


ALIGNED = (
    "doc_id long, container long, slot int, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "pair long, plane int, bits long, bitmap binary"
)
_ALIGNED = pa.schema(
    [("doc_id", pa.int64()), ("container", pa.int64()), ("slot", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
     ("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()), ("bits", pa.int64()), ("bitmap", pa.binary())]
)


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ALIGNED], schema=_ALIGNED
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        upto, lo = np.cumsum(sizes), 0
        while lo < batch.num_rows:
            base = upto[lo - 1] if lo else 0
            hi = min(max(lo + 1, int(np.searchsorted(upto, base + SLICE_CHARS, "right"))), lo + SLICE_TEXTS)
            part = batch.slice(lo, hi - lo)
            yield part.column(0), part.column(1).to_pylist()
            lo = hi


def _postings(path_a: str | None, path_b: str | None):
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        align = aligner(path_a, path_b).align
        container, docs, links = TaskContext.get().partitionId() << 33, 0, 0
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (pair, slot, links) of the container's slices

        def close() -> Iterator[pa.RecordBatch]:
            """OR-merge the slices' postings: their documents differ, so merging is sorting them together."""
            pair, slot, count = (np.concatenate(x) for x in zip(*kept))
            order = np.lexsort((slot, pair))
            pair, slot, count = pair[order], slot[order], count[order]
            starts = np.flatnonzero(np.diff(pair, prepend=-1))
            for plane, which, bits, maps in bitmaps(slot, count, starts):
                n = len(which)
                yield _batch(n, container=np.full(n, container), pair=pair[starts[which]], plane=np.full(n, plane, np.int32), bits=bits, bitmap=maps)

        for ids, texts in _slices(batches):
            if kept and (docs + len(texts) > CONTAINER or links > CONTAINER_LINKS):
                yield from close()
            if docs + len(texts) > CONTAINER or links > CONTAINER_LINKS:
                container, docs, links, kept = container + 1, 0, 0, []
            rows, owner, pairs = align(texts)
            n = len(texts)
            n_a, n_b, groups, digest = zip(*rows)
            yield _batch(
                n, doc_id=ids, container=np.full(n, container), slot=np.arange(docs, docs + n, dtype=np.int32), n_a=n_a, n_b=n_b, n_groups=groups, groups_sha256=digest
            )
            if len(pairs):
                names, local = np.unique(pairs, return_inverse=True)
                key, count = np.unique(local * SLICE_TEXTS + owner, return_counts=True)
                kept.append((names[key // SLICE_TEXTS], docs + key % SLICE_TEXTS, count))
            docs, links = docs + n, links + len(pairs)
        if kept:
            yield from close()

    return postings


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links, best) over all containers; ``best``: no pair of the same B id has more links."""
    weight = F.when(F.col("plane") < 0, F.lit(1)).otherwise(F.pow(F.lit(2), F.col("plane")).cast("long"))
    counts = postings.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") < 0, F.col("bits")).otherwise(0)).alias("n_docs"), F.sum(F.col("bits") * weight).alias("n_links")
    )
    counts = stage(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-counts")
    # At most one row for each id of B's vocabulary.
    most = small_side(counts.groupBy("b").agg(F.max("n_links").alias("most")))
    return counts.join(most, "b").select("pair", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


SCORES = "container long, slot int, n_best long, count_sum long"


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of scores by document, container by container (rows sorted by container)."""
    now, best, total = None, np.zeros(CONTAINER, np.int64), np.zeros(CONTAINER, np.int64)

    def rows() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), now)), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])], names=["container", "slot", "n_best", "count_sum"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        container = batch.column(0).to_numpy(zero_copy_only=False)
        weight = np.int64(1) << np.maximum(batch.column(1).to_numpy(zero_copy_only=False), 0).astype(np.int64)
        score = batch.column(3).to_numpy(zero_copy_only=False) * weight
        hit = np.where(batch.column(4).to_numpy(zero_copy_only=False), weight, 0)
        maps = batch.column(2).to_pylist()
        starts = np.r_[0, np.flatnonzero(np.diff(container)) + 1, len(container)].tolist()
        for lo, hi in zip(starts[:-1], starts[1:]):
            if container[lo] != now:
                if now is not None:
                    yield rows()
                now = int(container[lo])
                best[:], total[:] = 0, 0
            plain = [i for i in range(lo, hi) if len(maps[i]) == PLAIN]
            for i in plain:
                at = positions(maps[i])
                total[at] += score[i]
                best[at] += hit[i]
            few = [i for i in range(lo, hi) if len(maps[i]) != PLAIN]
            at = np.frombuffer(b"".join([maps[i] for i in few]), "<u2").astype(np.int64)
            n = np.array([len(maps[i]) // 2 for i in few], np.int64)
            np.add.at(total, at, np.repeat(score[few], n))
            np.add.at(best, at, np.repeat(hit[few], n))
    if now is not None:
        yield rows()


def align_tokenizers(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair no other pair of the same B id
    exceeds), count_sum (corpus-wide counts of the document's links, summed), groups_sha256. Pairs: a_id, b_id,
    n_docs, n_links, best.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned = stage(texts.mapInArrow(_postings(path_a, path_b), ALIGNED), "alignments")
    postings = aligned.filter("pair is not null").select("container", "pair", "plane", "bits", "bitmap")
    pairs = stage(pair_counts(postings), "pairs")
    scored = postings.join(pairs.select("pair", "n_links", "best"), "pair").select("container", "plane", "bitmap", "n_links", "best")
    scored = scored.repartition("container").sortWithinPartitions("container").mapInArrow(_scores, SCORES)
    rows = aligned.filter("pair is null").select("doc_id", "container", "slot", "n_a", "n_b", "n_groups", "groups_sha256")
    out = rows.join(scored, ["container", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),  # one link closes each group
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
    named = pairs.select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"), "n_docs", "n_links", "best")
    return out, named
