"""Exact top-k, packing and token files against brute force."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattage.llm import blocks, packing, token_counts, token_files, topk
from wattage.llm.tokens import Encoder


@pytest.fixture(scope="module")
def encoder():
    return Encoder()


ODD_TEXTS = [None, "", " ", "a", "  b ", " x\n\n y", "a\xa0 b", "\n", "é è  x", "'s don't 'll", "a\t b\r\n c", "x <|endoftext|> y", "a\x1c b!\x1dc", "漢字 かな", "z" * 30_000, "w " * 9_000]


# --- top-k


def brute_top_k(rows, k):
    seen = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(64 * x) for x in v]
        seen[i] = min(seen.get(i, q), q)
    out = []
    for i, q in seen.items():
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in seen.items() if j != i and len(c) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_k_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0, rng.random()]) for _ in range(4)]) for i in range(150)]
    rows += [(200, None), (220, [1.0, None, 1.0, 1.0]), (240, [float("nan"), 0.0, 0.0, 0.0]), (260, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(7, rows[7][1]), (20, rows[20][1]), (300, [0.5, 0.5]), (301, [0.25, 0.5]), (320, []), (321, []), (340, [1e12, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<double>, score double, dims int")
    for shard, tile in ((8_192, 2_048), (16, 3)):
        got = topk.top_k(topk.quantised(df), F.col("vec_id") % 20 == 0, 20, shard_rows=shard, tile_rows=tile)
        assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute_top_k(rows, 20)


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.quantised(df), F.col("vec_id") % 20 == 0, 20).collect() == []


def test_top_k_large_components_are_exact():
    q = np.array([[1 << 40, -(1 << 40)]], np.int64)
    assert topk._scores(q, q).tolist() == [[(1 << 63) - 1]]  # held at the end of a long
    assert topk._scores(q // 1024, q // 1024).tolist() == [[2 << 60]]


# --- tokens


def test_encoder_equals_the_library(encoder):
    rng = random.Random(5)
    texts = ODD_TEXTS + ["".join(rng.choice("ab é\n \t.,'1\xa0漢") for _ in range(rng.randrange(60))) for _ in range(500)]
    n, ids = encoder.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_added_tokens_are_those_of_the_file(encoder):
    from tokenizers import Tokenizer
    from wattage.llm.tokens import public_tokenizer

    fresh = Tokenizer.from_file(public_tokenizer())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y z", "a <|endoftext| > b", "a <|endof text|>", "plain words"]
    n, ids = encoder.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in fresh.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275] and n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_encoder_cache_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr("wattage.llm.tokens.CACHE_ENTRIES", 40)
    texts = [" ".join(f"word{i}x{j}" for j in range(12)) for i in range(30)]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    small = Encoder()
    for t, w in zip(texts, want):
        assert small.encode(pa.array([t]))[1].tolist() == w
        assert len(small.young) + len(small.old) <= 60


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=300), max_size=6))
def test_blocks_round_trip(docs):
    ids = np.array([i for d in docs for i in d], np.uint32)
    names = [None if k % 3 == 2 else -k for k in range(len(docs))]
    data = blocks.encode_file(names, np.array([len(d) for d in docs], np.int64), ids)
    got_ids, null, n, out = blocks.decode_file(data)
    assert [None if z else int(i) for i, z in zip(got_ids, null)] == names
    assert n.tolist() == [len(d) for d in docs] and out.tolist() == ids.tolist()
    if len(ids):
        b = (len(ids) - 1) // blocks.BLOCK
        assert blocks.read_block(data, b).tolist() == ids[b * blocks.BLOCK :].tolist()


def test_blocks_refuse_other_files():
    with pytest.raises(ValueError):
        blocks.decode_file(b"PARQUET1" + bytes(64))


def test_block_files_need_little_memory_beside_ids_and_file():
    import tracemalloc

    ids = ((np.arange(1_500_000, dtype=np.int64) ** 2 * 7919) % 50257).astype(np.uint32)
    ids[::97] = 4_000_000_000
    data = blocks.encode_file([1, None], np.array([100, len(ids) - 100]), ids)
    for work, held in ((lambda: blocks.encode_file([1], np.array([len(ids)]), ids), 2 * len(data)), (lambda: blocks.decode_file(data), 2 * ids.nbytes)):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < held + 14_000_000, peak
    small = ids[:300_000]
    assert zlib.crc32(blocks.encode_file([1, None], np.array([100, 299_900]), small)) == 466136854  # the format is as it was
    assert (blocks.decode_file(data)[3] == ids).all()


def test_chunks_in_use_stay_in_the_cache(monkeypatch):
    from wattage.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 40)
    encoder, learned = Encoder(), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda chunks: (learned.extend(chunks), learn(chunks)))
    want = Encoder().tokenizer
    for i in range(30):
        text = "often " + " ".join(f"once{i}x{j}" for j in range(6))
        assert encoder.encode(pa.array([text]))[1].tolist() == want.encode(text, add_special_tokens=False).ids
        assert len(encoder.young) <= 20 and len(encoder.old) <= 20
    assert learned.count("often") == 1


def test_token_files(spark, documents, encoder, monkeypatch):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (3, "same id, other text"), (5, ODD_TEXTS[5])]
    docs = documents(rows).repartition(5)
    want = sorted((i if i is not None else -1, len(ids := encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t in rows)
    for file_ids in (token_files.FILE_IDS, 50):  # one file, or many
        folder = token_files.shared_folder(spark, "test-ids")
        manifest = token_files.write_token_files(docs, folder, 2, file_ids=file_ids)
        out = token_files.read_token_files(spark, folder, manifest).join(token_files.file_starts(manifest), "file")
        got = out.select("doc_id", (F.col("first") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32").collect()
        assert sorted((-1 if r[0] is None else r[0], r[2], r[3]) for r in got) == want
        at = 0
        for r in sorted(got, key=lambda r: r[1]):
            assert r[1] == at
            at += r[2]
        order = [-1 if r[0] is None else r[0] for r in sorted(got, key=lambda r: r[1])]
        assert order == sorted(order)


def test_token_files_empty(documents):
    assert token_files.token_files(documents([]), 2).collect() == []


# --- token counts


def test_token_counts(documents, encoder, monkeypatch):
    texts = ODD_TEXTS + ["a b c"] * 5 + ["word " * k for k in range(40)]
    lengths = [len(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert encoder.lengths(pa.array(texts, pa.string())).tolist() == lengths
    monkeypatch.setattr(token_counts, "RANGE", 7)
    totals = token_counts.totals_by_limit(token_counts.length_histogram(documents(list(enumerate(texts)))))
    got = {r["context_limit"]: r for r in totals.collect()}
    assert set(got) == set(lengths)
    for limit, r in got.items():
        fitting = [n for n in lengths if n <= limit]
        assert (r["n_docs"], r["docs_fitting"], r["tokens_fitting"]) == (lengths.count(limit), len(fitting), sum(fitting))
        assert r["docs_cut"] == len(lengths) - len(fitting) and r["truncated_total"] == sum(min(n, limit) for n in lengths)
        assert r["tokens_cut"] == sum(max(n - limit, 0) for n in lengths) and r["share_fitting"] == len(fitting) / len(lengths)
    asked = {r["share"]: r["length"] for r in token_counts.quantiles(totals, (0.1, 0.5, 0.99, 1.0)).collect()}
    ordered = sorted(lengths)
    assert asked == {q: ordered[math.ceil(q * len(ordered)) - 1] for q in (0.1, 0.5, 0.99, 1.0)}
    limits = (-1, 0, 3, 100, 10**6)
    assert {r["context_limit"]: (r["docs_fitting"], r["truncated_total"]) for r in token_counts.at_limits(totals, limits[1:]).collect()} == {
        x: (sum(n <= x for n in lengths), sum(min(n, x) for n in lengths)) for x in limits[1:]
    }


def test_token_counts_empty(documents):
    assert token_counts.totals_by_limit(token_counts.length_histogram(documents([]))).collect() == []


# --- packing


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plan_is_a_packing(lengths):
    plan = packing.plan_runs(dict(lengths), 64)
    at = {}
    size_of = [s for s in sorted(lengths, reverse=True) for _ in range(lengths[s])]
    seen = set()
    for p in plan:
        for i in range(p.count):
            assert p.rank + i not in seen
            seen.add(p.rank + i)
            at.setdefault(p.sequence + i, []).append((p.offset, size_of[p.rank + i]))
    assert seen == set(range(len(size_of)))
    for pieces in at.values():
        fill = 0
        for offset, size in sorted(pieces):
            assert offset == fill
            fill += size
        assert fill <= 64
    # Never worse than first-fit decreasing by more than a few sequences.
    bins = []
    for s in size_of:
        for k, free in enumerate(bins):
            if free >= s:
                bins[k] -= s
                break
        else:
            bins.append(64 - s)
    assert len(at) <= len(bins) * 11 / 9 + 1


def test_pack(documents, encoder):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (3, ODD_TEXTS[3])]
    out = packing.pack(documents(rows), 0, context=64).collect()
    texts = sorted(len(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r["length"] for r in out) == sum(texts)
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append(r)
    for pieces in by.values():
        fill = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == fill
            fill += r["length"]
        assert fill <= 64
    long = sorted((r for r in out if r["doc_id"] == len(ODD_TEXTS) - 1), key=lambda r: r["piece"])
    ids = encoder.tokenizer.encode(ODD_TEXTS[-1], add_special_tokens=False).ids + [0]
    assert [r["piece"] for r in long] == list(range(len(long)))
    assert all(r["length"] == 64 for r in long[1:])
    for r in long:
        assert zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]


def test_pack_empty(documents):
    assert packing.pack(documents([])).collect() == []
