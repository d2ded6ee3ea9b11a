"""Near-duplicate groups: one-permutation MinHash, banded buckets, star-shaped candidates.

1. Each document becomes its set of word shingles (64-bit keys), a digest of the set and
   a one-permutation signature; an empty bin takes the value of the filled bin that comes
   first in a fixed random order of its own (optimal densification), so that two bins
   agree with the probability of the sets' similarity whatever the set sizes.
2. Equal sets collapse to one node. Bands of signature bins are bucket keys; with 48 bands
   of 6 bins a pair at similarity 0.8 shares no bucket once in two million pairs.
3. In a bucket every node is paired with the bucket's smallest node only (a star), so
   candidates grow with the members, not with their pairs. Each is confirmed on the
   full sets.
4. Confirmed links give components by alternating large-star and small-star steps.
5. A star may miss a link between two members that are both unlike its centre. So buckets
   that still hold several components are searched again without the star: nodes outside
   the bucket's main component are compared, block by block, with all its members, by
   size and signature and then on the full sets. Only links that join components leave a
   pair of blocks. A node that asks is copied to every block of its bucket, and members to every
   block that asks: with blocks of ``BLOCK`` members a large bucket of unlike members costs their
   number squared over ``BLOCK`` rows. Then components again.

A text that is null or without words has an empty set and is linked with nothing. Rows
that repeat a document each get a row. A row with a null doc_id is linked like any other
but is never the group's representative unless the group has no other. Other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import small_side
from .common import slices, stage, stage_apart, text_hash

BANDS = 48
ROWS = 6
BINS = BANDS * ROWS
THRESHOLD = 80  # per cent
#: Part of equal bins under which a pair is not confirmed in step 5: at similarity 0.8 the part is
#: 0.8 with a deviation of 0.024, so 0.68 is five deviations below.
AGREE = 0.68
# Nodes of a bucket compared with each other at once in step 5.
BLOCK = 500
TEXTS_AT_ONCE = 512
WORD_CACHE = 500_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit keys of words; bounded, the keys depend on the word alone."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        key = self[word] = xxhash.xxh3_64_intdigest(word)
        return key


_WORDS = _Words()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct keys of the k-word shingles; a shorter text is one shingle of all its words.

    Words are runs between ASCII white space, A-Z lower-cased: what bytes' own methods do.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    size = min(n, k)
    key = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        key = _mix(key * _M1 + h[i : n - size + 1 + i])
    return np.unique(key)


_ORDER: np.ndarray | None = None


def _order() -> np.ndarray:
    """For each bin, the rank of every other bin in its own random order (fixed)."""
    global _ORDER
    if _ORDER is None:
        draw = np.random.Generator(np.random.PCG64(20_240_601))
        _ORDER = np.argsort(draw.random((BINS, BINS)), axis=1).argsort(axis=1).astype(np.int32)
    return _ORDER


def signature(keys: np.ndarray) -> np.ndarray:
    """One-permutation signature of a non-empty set, densified."""
    h = _mix(keys + _M1)
    bins = ((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    packed = np.sort((bins << np.uint64(48)) | (_mix(h) >> np.uint64(16)))
    bins = (packed >> np.uint64(48)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = bins[first]
    out = np.empty(BINS, np.uint64)
    out[filled] = packed[first] & np.uint64((1 << 48) - 1)
    if len(filled) < BINS:
        empty = np.ones(BINS, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        out[empty] = out[filled[_order()[empty][:, filled].argmin(axis=1)]]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for column in sig.reshape(BANDS, ROWS).T:
        key = _mix(key * _M1 + column)
    return key.view(np.int64)


SIGNED = "doc_id long, text_key long, n long, digest binary, bands array<long>, sig binary"


def _sign(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, TEXTS_AT_ONCE):
            n, digest, bands, sig = [], [], [], []
            for text in batch.column(2).to_pylist():
                keys = shingle_set(text, k)
                n.append(len(keys))
                if not len(keys):
                    digest.append(None), bands.append(None), sig.append(None)
                    continue
                digest.append(xxhash.xxh3_128_digest(keys.tobytes()))
                s = signature(keys)
                bands.append(band_keys(s))
                sig.append(s.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["doc_id", "text_key", "n", "digest", "bands", "sig"],
            )

    return sign


def _sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS_AT_ONCE):
            keys = [shingle_set(t, k).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["node", "keys"])

    return sets


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of ``links`` (a, b: long).

    Alternating large-star and small-star steps; each is a group-by and a join on stored
    rows, and their number grows with the logarithm of the longest chain.
    """

    def stars(df: DataFrame) -> bool:
        """Whether every node has one parent at most and no parent has one: then each points at its root."""
        child = df.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
        roles = child.union(df.select("v", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
        return roles.filter("c > 1 or c = 1 and p = 1").isEmpty()

    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), "least")
        large = stage(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots.select("node", F.col("node").alias("comp")))


def _shingle_sets(needed: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(node, keys) for needed nodes (node, doc, key), from one text of each node.

    The node list is broadcast where its measured size allows, so that texts stay where they are."""
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key"))
    source = texts.join(small_side(needed), same).select("node", "text")
    # Rows that repeat a document give equal sets.
    return stage(source.mapInArrow(_sets(k), "node long, keys array<long>").dropDuplicates(["node"]), "shingle-sets")


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of pairs (a, b) of nodes, those similar on their full shingle sets."""
    left = sets.select(F.col("node").alias("a"), F.col("keys").alias("ka"))
    right = sets.select(F.col("node").alias("b"), F.col("keys").alias("kb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ka", "kb"))
    return both.filter(100 * shared >= threshold * (F.size("ka") + F.size("kb") - shared)).select("a", "b")


def _units(pdf: pd.DataFrame):
    """(unit, rows) of a group's units; columns that hold vectors as matrices."""
    pdf = pdf.sort_values(["unit", "node"], kind="stable")
    sig = np.stack([np.frombuffer(x, np.uint8) for x in pdf["sig"]])
    bands = np.stack(pdf["bands"].to_numpy())
    starts = np.flatnonzero(np.r_[True, np.diff(pdf["unit"].to_numpy()) != 0, True])
    for lo, hi in zip(starts[:-1], starts[1:]):
        yield pdf.iloc[lo:hi], sig[lo:hi], bands[lo:hi]


def _partners(rows: pd.DataFrame, sig: np.ndarray, bands: np.ndarray):
    """For each asking row of a unit: positions of the members it may be similar to, the likeliest first.

    A pair is looked at in the first band that its nodes share, and once if both ask.
    """
    node, comp, n = rows["node"].to_numpy(), rows["comp"].to_numpy(), rows["n"].to_numpy()
    asks, band = rows["asks"].to_numpy(), int(rows["band"].iloc[0])
    offered = rows["offered"].to_numpy()
    for q in np.flatnonzero(rows["asked"].to_numpy()):
        may = offered & (comp != comp[q]) & ~(asks & (node >= node[q]))
        may &= np.minimum(n, n[q]) * 100 >= np.maximum(n, n[q]) * THRESHOLD
        at = np.flatnonzero(may)
        if len(at):
            at = at[(bands[at] == bands[q]).argmax(axis=1) == band]
        if len(at):
            agree = (sig[at] == sig[q]).mean(axis=1)
            order = np.argsort(-agree, kind="stable")
            at = at[order][agree[order] >= AGREE]
        if len(at):
            yield q, at


def _near(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows of each unit that have a possible partner in it."""
    out = []
    for rows, sig, bands in _units(pdf):
        hit = np.zeros(len(rows), bool)
        for q, at in _partners(rows, sig, bands):
            hit[q] = True
            hit[at] = True
        out.append(rows.loc[hit, ["unit", "node", "asked", "offered"]])
    return pd.concat(out) if out else pdf.iloc[:0][["unit", "node", "asked", "offered"]]


def _links(threshold: int):
    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        """Confirmed pairs, but for those whose components the unit has joined already."""
        out: list[tuple[int, int]] = []
        for rows, sig, bands in _units(pdf):
            node, comp, keys = rows["node"].to_numpy(), rows["comp"].to_numpy(), rows["keys"].to_numpy()
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while (up := parent.get(c, c)) != c:
                    c = up
                return c

            for q, at in _partners(rows, sig, bands):
                for m in at:
                    a, b = root(comp[q]), root(comp[m])
                    if a == b:
                        continue
                    shared = len(np.intersect1d(keys[q], keys[m], assume_unique=True))
                    if 100 * shared >= threshold * (len(keys[q]) + len(keys[m]) - shared):
                        parent[a] = b
                        out.append((max(node[q], node[m]), min(node[q], node[m])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def _missed_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Step 5: links (a, b) between components that share a bucket, beyond the star's.

    A unit of work is a bucket, or a pair of its blocks if it is large. Its nodes outside
    the bucket's main component ask all its members; only links leave a unit, at most one
    per component it holds. Small units share a group.
    """
    crowd = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    crowd = crowd.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("main"), F.sum("c").alias("size"), F.count(F.lit(1)).alias("comps"))
    # In a bucket of two the star has compared the only pair.
    mixed = crowd.filter("comps > 1 and size > 2").select("key", F.col("main.comp").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(stage(mixed, "mixed-buckets"), "key")
    rows = rows.select("key", "node", "comp", (F.col("comp") != F.col("main")).alias("asks"), "blocks", F.pmod(F.hash("node"), F.col("blocks")).alias("block"))
    rows = stage(rows, "mixed-members")
    whole = rows.filter("blocks = 1").select(F.xxhash64("key").alias("unit"), "key", "node", "comp", "asks", F.col("asks").alias("asked"), F.lit(True).alias("offered"))
    large = rows.filter("blocks > 1")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asked = large.filter("asks").select("key", "node", "comp", "asks", F.col("block").alias("q"), every.alias("m"))
    wanted = asked.select("key", "q").distinct()  # blocks without a question need no members
    offered = large.join(wanted, "key").select("key", "node", "comp", "asks", "q", F.col("block").alias("m"))
    unit = F.xxhash64("key", "q", "m").alias("unit")
    parts = asked.select(unit, "key", "node", "comp", "asks", F.lit(True).alias("asked"), F.lit(False).alias("offered")).union(
        offered.select(unit, "key", "node", "comp", "asks", F.lit(False).alias("asked"), F.lit(True).alias("offered"))
    )
    signed = nodes.select("node", "n", "sig", "bands")
    work = whole.union(parts).join(signed, "node").withColumn("band", (F.array_position("bands", F.col("key")) - 1).cast("int"))
    work = stage(work.drop("key"), "mixed-units")
    groups = max(1, -(-work.count() // (2 * BLOCK)))
    # A unit is in one group; a group has one large unit or about 2 * BLOCK rows of small ones.
    group = F.pmod(F.xxhash64("unit"), F.lit(groups))
    near = work.groupBy(group).applyInPandas(_near, "unit long, node long, asked boolean, offered boolean")
    near = stage(near, "near-members")
    full = near.join(work, ["unit", "node", "asked", "offered"]).join(sets, "node")
    return full.groupBy(group).applyInPandas(_links(threshold), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, text_key, n_shingles, component_id, kept, component.

    ``component_id`` is the smallest doc_id of a group, which several groups share if ids are null
    or repeat; ``component`` (its smallest node, null without words) tells groups apart.
    Links hold between documents whose sets of ``k``-word shingles have 100 * intersection >=
    ``threshold`` * union (80 or more; the bands are chosen for that).
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", text_hash().alias("text_key"), "text")

    def signed_nodes() -> list[DataFrame]:
        signed = stage(texts.mapInArrow(_sign(k), SIGNED), "signatures")
        # Equal sets are one node, numbered once and stored.
        smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("first")
        nodes = signed.filter("n > 0").groupBy("digest").agg(smallest, F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        nodes = nodes.select(
            F.monotonically_increasing_id().alias("node"), "digest", F.col("first.doc_id").alias("doc"), F.col("first.text_key").alias("key"), "n", "bands", "sig"
        )
        return [nodes, signed.select("doc_id", "text_key", "n", "digest")]

    # A document's signature goes on with its node; the rows keep the digest only.
    nodes, signed = stage_apart(docs.sparkSession, signed_nodes, "nodes", "digests")
    banded = nodes.select("node", "n", F.explode("bands").alias("key"))
    centres = banded.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    centres = stage(centres.select("key", "centre"), "buckets")
    members = stage(banded.join(centres, "key").select("key", "node", "n", "centre"), "members")
    star = members.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b"), F.col("n").alias("na")).distinct()
    sizes = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"))
    close = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold
    star = stage(star.join(sizes, "b").filter(close).select("a", "b"), "star-pairs")
    shared = members.select("node").distinct().join(nodes.select("node", "doc", "key"), "node")
    sets = _shingle_sets(shared, texts, k)
    links = stage(_confirm(star, sets, threshold), "star-links")
    found = nodes.select("node").join(components(links), "node", "left")
    found = stage(found.select("node", F.coalesce("comp", "node").alias("comp")), "star-components")
    more = stage(_missed_links(members.select("key", "node").join(found, "node"), nodes, sets, threshold), "missed-links")
    # The components themselves are the nodes of what is left to join.
    of = lambda end: found.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
    joined = components(more.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = joined.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    grouped = nodes.select("digest", "node", "doc").join(found, "node").join(joined, "comp", "left")
    grouped = grouped.select("digest", "doc", F.coalesce("root", "comp").alias("comp"))
    names = grouped.groupBy("comp").agg(F.min("doc").alias("component_id"))
    named = grouped.join(names, "comp").select("digest", "component_id", F.col("comp").alias("component"))
    out = signed.select("doc_id", "text_key", "n", "digest").join(named, "digest", "left")
    # A document without words is alone.
    first = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("doc_id") == first, first.isNull())
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), first.alias("component_id"), kept.alias("kept"), "component")
