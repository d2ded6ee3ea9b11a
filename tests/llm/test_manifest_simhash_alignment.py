"""Merkle manifest, SimHash groups and tokenizer alignment against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from wattage.llm import alignment, merkle, simhash
from wattage.llm.tokens import public_tokenizer


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- Merkle manifest


def brute_tree(nodes, fanout):
    paths, cur, pos = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(cur) > 1:
        for i, p in enumerate(pos):
            first = p - p % fanout
            run = cur[first : first + fanout]
            paths[i].append(("".join(run[: p - first]), "".join(run[p - first + 1 :])))
            pos[i] = p // fanout
        cur = [H("".join(cur[i : i + fanout])) for i in range(0, len(cur), fanout)]
    return cur[0], paths


def brute_manifest(rows, fanout):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"], H("".join(field(r[c]) for c in merkle.FIELDS))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [brute_tree([d for _, d in groups[g]], fanout) for g in names]
    root, upper = brute_tree([t for t, _ in trees], fanout)
    return sorted(
        str((i, d, top, root, [*path, *up])) for g, (top, paths), up in zip(names, trees, upper) for (i, d), path in zip(groups[g], paths)
    )


def manifest_docs(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.randrange(4)), "hot", f"s{i % 3}", i) for i in range(77)]
    rows += [(i, "é" * i, rng.choice(["é", "z", "", None, "b"]), None, None) for i in range(40)]
    rows += [(None, None, "hot", None, None), (None, "x", "solo", "s", 1), (5, "twice", "hot", "s", 2), (5, "twice", "hot", "s", 2), (1 << 62, "y " * 50_000, "z", "s", (1 << 63) - 1)]
    rows += [(i, "w", f"g{i:02}", "s", 1) for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS g", "2 AS digest", "3 AS payload", "4 AS blk").repartition(4)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_brute_force(spark, fanout):
    docs = manifest_docs(spark)
    got = merkle.merkle_manifest(docs, fanout=fanout).collect()
    assert sorted(str((r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["l"], s["r"]) for s in r["path"]])) for r in got) == brute_manifest(docs.collect(), fanout)


def test_only_tampered_leaves_fail(spark):
    import zlib

    docs = manifest_docs(spark)
    got = merkle.merkle_manifest(docs.withColumn("t", merkle.tampered_leaf(docs)), carry=["t"])
    got = got.withColumn("ok", merkle.fold(F.col("path"), F.coalesce("t", "leaf")) == F.col("root")).collect()
    null = {(r["doc_id"]) for r in docs.filter("n_chars is null").collect()}
    assert {r["ok"] for r in got} == {True, False}
    for r in got:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        if r["doc_id"] not in null:
            assert r["ok"] is not hit
        assert r["ok"] or hit


def test_manifest_of_little(documents):
    assert merkle.merkle_manifest(documents([])).collect() == []
    (row,) = merkle.merkle_manifest(documents([(1, None)])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == []
    with pytest.raises(ValueError):
        merkle.merkle_manifest(documents([]), fanout=1)


# --- SimHash


def brute_fingerprint(text, k=3):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), seed=42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


@pytest.mark.parametrize("piece", [4_000_000, 5])
def test_fingerprints(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "A b", "É e\x0bÉ", "a a a a a", " lead  and tail\r\n", "x" * 500 + " y z", words(rng, 300)]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def brute_components(prints, most=3):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_points_within_the_threshold_share_an_anchor(most):
    rng = np.random.default_rng(most)
    x = rng.integers(0, 1 << 63, 2_000, dtype=np.uint64)
    y = x.copy()
    for _ in range(most):
        y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
    anchors = simhash.Anchors(most)
    near = [set(zip(*(v.tolist() for v in anchors.near(p)))) for p in (x, y)]
    assert {i for i, _ in near[0] & near[1]} == set(range(len(x)))


@pytest.mark.parametrize("block", [8_192, 3])
def test_near_links(spark, block):
    """Random points, chains of near points, and one dense cluster; blocks of three cut every anchor."""
    rng = random.Random(block)
    points = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 7}
    for p in list(points)[:25]:
        for _ in range(4):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                p ^= 1 << b
            points.add(p)
    centre = rng.getrandbits(64)
    points |= {centre ^ sum(1 << b for b in rng.sample(range(12), 3)) for _ in range(120)}
    points = sorted(points)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp long").repartition(3)
    links = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(frame, block=block).collect()}
    assert all(bin(a ^ b).count("1") <= 3 for a, b in links)
    want = brute_components(points)
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    got = [root(p) for p in points]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_links_of_an_anchor_stay_linear():
    prints = np.array([1 << i for i in range(64)] + [0], np.uint64)  # all 2 bits apart or less
    assert len(simhash.spanning_links(prints, 3)) == len(prints) - 1


def test_simhash_groups_brute_force(documents):
    rng = random.Random(9)
    rows = [(None, "no id"), (None, "no  ID"), (7, "no id at all"), (50, ""), (40, None), (41, " \n"), (3, "one"), (3, "one")]
    for i in range(30):
        base = words(rng, 400).split()
        rows.append((100 + 10 * i, " ".join(base)))
        for j in range(3):
            base[rng.randrange(len(base))] = f"n{j}"
            rows.append((rng.choice([100 + 10 * i + j + 1, 100 + 10 * i - j]), " ".join(base)))
    got = simhash.simhash_groups(documents(rows).repartition(3)).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    groups = brute_components(prints)
    least = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(str((i, f"{p:016x}", least.get(g))) for (i, _), p, g in zip(rows, prints, groups))
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in got) == want
    assert len(set(groups)) < len(set(prints))


def test_simhash_of_nothing(documents):
    assert simhash.simhash_groups(documents([])).collect() == []


# --- alignment


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizer("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizer("piece_bpe_32k.model"))


def brute_alignment(tokenizers, text):
    a, b = tokenizers
    if not text:
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(x): x for x in printable}
    back |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}
    bytes_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    piece = b.id_to_piece
    bytes_b = lambda i: bytes([int(piece(i)[3:-1], 16)]) if b.is_byte(i) else piece(i).replace("▁", " ").encode()
    x, y, raw = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
    if b"".join(map(bytes_a, x)) != raw or b"".join(map(bytes_b, y)) != raw:
        return None
    end_a, end_b = {}, {}
    for ids, size, ends in ((x, bytes_a, end_a), (y, bytes_b, end_b)):
        at = 0
        for i, t in enumerate(ids):
            at += len(size(t))
            ends[at] = i
    groups, links, p, q = [], [], 0, 0
    for end in sorted(end_a.keys() & end_b.keys()):
        i, j = end_a[end], end_b[end]
        groups.append(",".join(map(str, x[p : i + 1])) + "|" + ",".join(map(str, y[q : j + 1])))
        links.append((x[i], y[j]))
        p, q = i + 1, j + 1
    return len(x), len(y), len(groups), links, H(";".join(groups))


ODD_TEXTS = [
    None, "", " ", "a  b", " lead", "tail ", "<|endoftext|> x <s> <0x41>", "a▁b c", "nb\xa0sp é ﬁ", "x\n y\n\nz\tq", "日本語 text 🙂🙂 ok",
    "w " * 20_000 + "w", "it's we'll  \x1c q", "wide　space", "a\x00b ́x", "a\x00b ́x", "x", "\n", "co-op (co-op) 3.14159", "A" * 3_000,
]


def alignment_rows():
    rng = random.Random(5)
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (1, "the id is there twice")]
    return rows + [(100 + i, words(rng, rng.randrange(1, 60), 30) + rng.choice([".", ", the end", " the the the"])) for i in range(80)]


def test_alignment_brute_force(documents, tokenizers):
    rows = alignment_rows()
    frame, pairs = alignment.align_tokenizers(documents(rows).repartition(3))
    found = [brute_alignment(tokenizers, t) for _, t in rows]
    count, docs = collections.Counter(), collections.Counter()
    for f in found:
        if f:
            count.update(f[3]), docs.update(set(f[3]))
    most = collections.defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    want = [
        (i, 0, 0, 0, 0, 0, 0, "") if not f else (i, *f[:3], len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]), f[4])
        for (i, _), f in zip(rows, found)
    ]
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(map(str, want))
    got = {(r["a_id"], r["b_id"]): (r["n_docs"], r["n_links"], r["best"]) for r in pairs.collect()}
    assert got == {x: (docs[x], n, n == most[x[1]]) for x, n in count.items()}


def test_small_containers(tokenizers, monkeypatch):
    """Bitmaps of many small containers hold each document's links, and the scores add them up."""
    import pyarrow as pa
    from pyspark import TaskContext

    class Task:
        @staticmethod
        def partitionId():
            return 3

    # Plain bits from two documents on.
    for name, value in (("CONTAINER", 24), ("PLAIN", 3), ("SLICE_TEXTS", 8), ("SLICE_CHARS", 500), ("CONTAINER_LINKS", 400)):
        monkeypatch.setattr(alignment, name, value)
    rows = alignment_rows()
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["doc_id", "text"])
    keep = TaskContext.get
    TaskContext.get = staticmethod(lambda: Task)
    try:
        out = pa.Table.from_batches(list(alignment._postings(None, None)(iter([batch.slice(0, 50), batch.slice(50)])))).to_pylist()
    finally:
        TaskContext.get = keep
    docs = [r for r in out if r["pair"] is None]
    maps = [r for r in out if r["pair"] is not None]
    assert len({r["container"] for r in docs}) > 3 and any(len(r["bitmap"]) == alignment.PLAIN for r in maps)
    links = collections.defaultdict(collections.Counter)
    for r in maps:
        assert len(alignment.positions(r["bitmap"])) == r["bits"]
        for slot in alignment.positions(r["bitmap"]).tolist():
            links[r["container"], slot][r["pair"] >> 32, r["pair"] & 0xFFFFFFFF] += 1 if r["plane"] < 0 else 1 << r["plane"]
    for (_, text), r in zip(rows, docs):
        want = brute_alignment(tokenizers, text)
        assert links[r["container"], r["slot"]] == collections.Counter(want[3] if want else [])
    maps.sort(key=lambda r: r["container"])
    weighed = pa.RecordBatch.from_pylist([{"container": r["container"], "plane": r["plane"], "bitmap": r["bitmap"], "n_links": r["pair"] % 11 + 1, "best": r["pair"] % 2 == 0} for r in maps])
    scores = {(r["container"], r["slot"]): (r["n_best"], r["count_sum"]) for b in alignment._scores(iter([weighed.slice(0, 90), weighed.slice(90)])) for r in b.to_pylist()}
    for at, found in links.items():
        pairs = [((a << 32 | b), n) for (a, b), n in found.items()]
        if pairs:
            assert scores[at] == (sum(n for p, n in pairs if p % 2 == 0), sum(n * (p % 11 + 1) for p, n in pairs))


def test_alignment_of_nothing(documents):
    frame, pairs = alignment.align_tokenizers(documents([]))
    assert frame.collect() == [] and pairs.collect() == []
