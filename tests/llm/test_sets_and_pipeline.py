"""Near-duplicates, decontamination and the pipeline against brute force."""

import hashlib
import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from wattage.llm import decontaminate, neardup
from wattage.llm.toxicity import Grammar, logistic, BIAS


def ascii_low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_low(text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_groups(rows, k, threshold=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= threshold * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


def corpus(seed=7):
    """Copies, near copies (also chains of them), and texts that share a passage."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = words(rng, rng.choice([3, 8, 40, 120])).split()
        rows.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            w = list(base)
            for _ in range(rng.randrange(1 + len(w) // 30)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(1000)}"
            rows.append(" ".join(w) + rng.choice(["", " tail", " "]))
        chain = list(base)
        for _ in range(3):
            chain = chain + [f"c{rng.randrange(1000)}" for _ in range(max(1, len(chain) // 9))]
            rows.append(" ".join(chain).upper())
    passage = words(rng, 60)
    rows += [f"{passage} {words(rng, rng.choice([10, 14, 40]))}" for _ in range(25)]
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_brute_force(documents, k):
    rows = corpus() + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1003, "one"), (1005, "é É"), (1006, "long " * 30_000)]
    got = neardup.near_duplicates(documents(rows).repartition(3), k=k).collect()
    sets, groups = brute_groups(rows, k)
    smallest = {}
    for (i, _), g in zip(rows, groups):
        smallest[g] = min(i, smallest.get(g, i))
    want = sorted((i, len(s), smallest[g], i == smallest[g]) for (i, _), s, g in zip(rows, sets, groups))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want


def test_near_duplicates_null_ids_and_empty(documents):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (None, "alone in the world it is"), (None, None)]
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in neardup.near_duplicates(documents(rows)).collect()}
    assert got[4, 2] == (4, True) and got[None, 0] == (None, True)
    both = sorted((str(r["doc_id"]), r["kept"]) for r in neardup.near_duplicates(documents(rows[:2])).collect())
    assert both == [("4", True), ("None", False)]
    assert neardup.near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("block", [500, 2])
def test_missed_links_are_found(spark, monkeypatch, block):
    """A bucket whose star centre (node 0) is unlike members that are alike."""
    import numpy as np

    monkeypatch.setattr(neardup, "BLOCK", block)
    base = np.unique(neardup._mix(np.arange(1, 201, dtype=np.uint64)))
    alike = [base, np.unique(np.r_[base[5:], base[:1]]), np.unique(base[10:])]
    other = [neardup._mix(np.arange(500 + 300 * i, 700 + 300 * i, dtype=np.uint64)) for i in range(3)]
    sets = [np.unique(x) for x in [other[0], *alike, *other[1:]]]
    rows = []
    for i, keys in enumerate(sets):
        sig = neardup.signature(keys)
        bands = neardup.band_keys(sig)
        bands[0] = 9  # one bucket for all
        rows.append((i, len(keys), bytearray(sig.astype(np.uint8).tobytes()), bands.tolist()))
    nodes = spark.createDataFrame(rows, "node long, n long, sig binary, bands array<long>")
    full = spark.createDataFrame([(i, k.view(np.int64).tolist()) for i, k in enumerate(sets)], "node long, keys array<long>")
    members = spark.createDataFrame([(9, n, n) for n in range(6)] + [(8, 0, 0), (8, 1, 1)], "key long, node long, comp long")
    links = {tuple(r) for r in neardup._missed_links(members, nodes, full, 80).collect()}
    assert links <= {(2, 1), (3, 1), (3, 2)} and len(links) >= 2
    assert {r["node"]: r["comp"] for r in neardup.components(spark.createDataFrame(list(links), "a long, b long")).collect()} == {1: 1, 2: 1, 3: 1}
    joined = spark.createDataFrame([(9, n, 1 if n in (1, 2, 3) else n) for n in range(6)], "key long, node long, comp long")
    assert neardup._missed_links(joined, nodes, full, 80).collect() == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["comp"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}


# --- decontamination


def brute_contamination(docs, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_low(t or ""))
    wins = {}
    for i, t in items:
        w = cut(t)
        for s in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[s : s + window]), set()).add(i)
    out = []
    for d, t in docs:
        w = cut(t)
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for s in range(len(w) - size + 1):
                if tuple(w[s : s + size]) in wins:
                    hit.update(range(s, s + size))
                    found |= wins[tuple(w[s : s + size])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def contamination_case():
    rng = random.Random(11)
    items = [(i, words(rng, rng.choice([1, 2, 3, 9, 10, 11, 30]), 60)) for i in range(30)]
    items += [(40, None), (41, ""), (42, "..."), (5, items[5][1]), (None, words(rng, 12, 60)), (43, "the " * 14)]
    docs = []
    for i in range(60):
        w = words(rng, rng.randrange(5, 80), 60).split()
        for _ in range(rng.randrange(3)):
            item = (items[rng.randrange(30)][1]).split()
            at = rng.randrange(len(w))
            w[at:at] = item[rng.randrange(len(item)) :] if rng.random() < 0.4 else item
        docs.append((i, ", ".join(w).upper() if i % 4 else "; ".join(w)))
    docs += [(100, None), (101, ""), (102, "the " * 500), (3, docs[3][1]), (None, items[20][1] or "x")]
    return docs, items


def test_contamination_brute_force(spark, documents):
    docs, items = contamination_case()
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, wid int")
    got = decontaminate.find_contamination(documents(docs), bench)
    got = got.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("h"), "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_contamination(docs, items)


def test_contamination_shuffled_joins_agree(spark, documents, monkeypatch):
    docs, items = contamination_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    got = decontaminate.find_contamination(documents(docs), bench).select("doc_id", "n_words", "n_hit", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(a, b, c, f) for a, b, c, _, _, f in brute_contamination(docs, items)]


def test_contamination_empty(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[2:4] for r in decontaminate.find_contamination(documents([(1, "a b c")]), none).select("doc_id", "n_words", "n_hit", "contaminated").collect()] == [(0, False)]
    assert decontaminate.find_contamination(documents([]), none).collect() == []


# --- pipeline


def test_pipeline_stages_brute_force(spark, documents, tmp_path):
    rows = corpus(5)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows += [(2000, "You are a stupid idiot. Pathetic."), (2001, f"intro {item} outro"), (2002, "my token = abcdef0123456789abcdef012 here"), (2003, None), (2004, ""), (2005, "not an idiot"), (2002, "my token = abcdef0123456789abcdef012 here"), (2003, None)]
    folder = str(tmp_path)
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema, kept = docs.columns, list(rows)
    grammar = Grammar([])
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, folder), f"test-{name}")
        assert docs.columns == schema
        if name == "toxicity":
            kept = [(i, t) for i, t in kept if logistic(sum(w for _, _, w in grammar.clauses(t)) - BIAS) < 0.7]
        elif name == "near_duplicates":
            sets, groups = brute_groups(kept, 5)
            best = {}
            for (i, t), s, g in zip(kept, sets, groups):
                if s:
                    best[g] = min(i, best.get(g, i))
            kept = sorted({(i, t) for (i, t), s, g in zip(kept, sets, groups) if not s or best[g] == i}, key=str)
        elif name == "decontamination":
            dirty = {d for d, *_, f in brute_contamination(kept, [(1, item)]) if f}
            kept = [(i, t) for i, t in kept if i not in dirty]
        else:
            kept = [(i, t.replace("token = abcdef0123456789abcdef012", "[assign]") if t else t) for i, t in kept]
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in docs.collect())
        got = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        assert got == sorted(kept, key=str), name
    assert {2003, 2004, 2005} <= {i for i, _ in kept} and not {2000, 2001} & {i for i, _ in kept}
    pieces = corpus_pipeline.pack_sequences(spark, docs, folder).collect()
    assert sorted({r["doc_id"] for r in pieces}) == sorted({i for i, _ in kept})
    assert len(corpus_pipeline.run(spark, folder).collect()) == len(pieces)


def test_pipeline_on_an_empty_table(spark, documents, tmp_path):
    folder = str(tmp_path)
    documents([]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_pipeline_keeps_unlike_texts_that_share_an_id(spark, documents):
    """Null ids and repeated ids name no group: one row of each group of like texts stays."""
    rows = [(None, "one text of its own kind here"), (None, "quite another story told in full"), (None, "one text of its own kind here"), (None, None), (None, "")]
    rows += [(7, "a third text that nobody else has"), (7, "and a fourth one unlike the third"), (9, "A third text that nobody else has"), (8, None), (8, None)]
    got = corpus_pipeline.drop_near_duplicates(spark, documents(rows), "").collect()
    want = {r for r in rows if r[0] != 9}
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)


def test_pipeline_ships_one_copy_of_repeated_rows(spark, documents, monkeypatch):
    """Rows repeated as a whole meet as one row of each map task, and in no window."""
    found = spark.createDataFrame([(1, 1, 2, 1, True, 0)], "doc_id long, text_key long, n_shingles long, component_id long, kept boolean, component long")
    monkeypatch.setattr(corpus_pipeline, "near_duplicates", lambda docs, **_: found)
    docs = documents([(1, "copied text")] * 50)
    plan = corpus_pipeline.drop_near_duplicates(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_first(row" in plan


def test_pipeline_chooses_among_unlike_rows_of_one_document_by_a_total_order(spark, documents):
    """Rows equal in id and text but not in other columns: the same one stays whatever the order they come in."""
    docs = documents([(1, "one text of its own kind here")])
    unlike = docs
    for lang in ("fr", None, "de"):
        unlike = unlike.union(docs.withColumn("lang", F.lit(lang)))
    got = {tuple(corpus_pipeline.drop_near_duplicates(spark, df, "").first()) for df in (unlike, unlike.orderBy(F.desc("lang")), unlike.repartition(3))}
    assert len(got) == 1


def test_pipeline_toxicity_drops_rows_by_id_and_text(spark, documents, tmp_path, monkeypatch):
    """Only the toxic text of a repeated id goes; null ids, null texts and other columns are kept."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    toxic = "you are a stupid pathetic idiot and a worthless moron. I will kill you, you idiot"
    rows = [(1, toxic), (1, "a calm text"), (None, toxic), (None, "another calm text"), (2, None), (2, None), (3, "")]
    got = corpus_pipeline.drop_toxic(spark, documents(rows), str(tmp_path))
    assert got.columns == documents(rows).columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([r for r in rows if r[1] != toxic], key=str)


def test_pipeline_leaves_no_tables_of_the_near_duplicate_search(spark, documents):
    from pathlib import Path
    from urllib.parse import urlparse

    from wattage.session import ensure_checkpoint_dir

    folder, rng = ensure_checkpoint_dir(spark), random.Random(5)
    text = words(rng, 60)
    docs = documents([(1, text), (2, text), (3, text + " end"), (4, words(rng, 50)), (5, None), (5, None), (None, "x y")])
    before = {p for p in Path(urlparse(folder).path).rglob("*.parquet")}
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((r.doc_id or -1, r.text) for r in out.collect()) == sorted([(1, text), (4, docs.filter("doc_id = 4").first().text), (5, None), (-1, "x y")], key=lambda r: r[0])
    new = {p.parent.name.rpartition("-")[0] for p in Path(urlparse(folder).path).rglob("*.parquet") if p not in before}
    assert new == {"chosen"} and ensure_checkpoint_dir(spark) == folder


def test_pipeline_leaves_texts_in_place_while_few_rows_go(spark, documents, monkeypatch):
    from wattage.operators import sizing

    rows = [(i, f"text {i}") for i in range(20)] + [(None, "no id"), (3, "other")]
    docs = documents(rows)
    found = docs.filter("doc_id = 3 and text = 'other' or doc_id is null or doc_id > 15").select("doc_id", corpus_pipeline.text_hash().alias("text_key"))
    monkeypatch.setattr(corpus_pipeline, "score_toxicity", lambda d, lexicon, carry: found.selectExpr("doc_id", "text_key", "0.9d score"))
    monkeypatch.setattr(corpus_pipeline, "labelled_sample", lambda *a: None)
    monkeypatch.setattr(corpus_pipeline, "learn_lexicon", lambda *a: [])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: None)
    want = sorted((i, t) for i, t in rows if i is not None and i <= 15 and t != "other")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, shuffled in ((sizing.BROADCAST_BYTES, False), (0, True)):  # both ways give the same rows
            monkeypatch.setattr(sizing, "BROADCAST_BYTES", most)
            out = corpus_pipeline.drop_toxic(spark, docs, "")
            assert sorted((r.doc_id, r.text) for r in out.collect()) == want
            assert ("Exchange hashpartitioning" in out._jdf.queryExecution().executedPlan().toString()) == shuffled
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
