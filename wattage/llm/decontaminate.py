"""Benchmark decontamination: prefix-filtered set join with exact window verification.

DataFrame functions only. An item is cut into windows of consecutive words; a window is
a set of short shingles, each with its place. A document that contains the window
contains all of its shingles, so the shortest sufficient prefix of the set, ordered by
rarity, is one shingle. The steps:

1. find every document position that starts a benchmark shingle (the only rows made from
   words; the shingle set is broadcast behind a count, shuffled beyond it);
2. order shingles by how often they occur; keep the rarest of each window as its prefix,
   and drop windows with a shingle that no document has;
3. join prefix shingles with the positions: shingle place and document length bound where
   a window can start;
4. verify each candidate start by comparing the window's words with the document's: the
   texts of documents with a candidate are shuffled, of all others only the number of words.

A null text, or a text without words, has no windows and no hits. Repeated document rows
each get their own result row, repeated items count once, a null item id adds hits but no
item. Empty tables give no rows (documents) or clean rows (benchmark). Columns other than
the four named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import small_side
from .common import ascii_lower, stage, text_hash

#: Fixed by the contract: what separates words, and the words of a window.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Words of a shingle (a shorter window is one shingle).
SHINGLE = 3
# Rows of benchmark shingles or windows that are broadcast (16 to 500 bytes each); above, shuffle joins.
BROADCAST_ROWS = 50_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingle(at: Column, size: int) -> Column:
    """Key of a shingle from a struct of its words."""
    return F.xxhash64(F.lit(size), *[at.getField(f"w{i}") for i in range(size)])


def _zipped(words: Column) -> Column:
    """words[p .. p + SHINGLE) at every position p (null past the end)."""
    shifted = [words, *[F.slice(words, F.lit(i + 1), F.size(words)) for i in range(1, SHINGLE)]]
    return F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(shifted)])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: words, items (distinct item ids as strings that have it)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    starts = items.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("s"))
    windows = starts.select("item", F.slice("w", F.col("s") + 1, F.lit(window)).alias("words"))
    return windows.groupBy("words").agg(F.collect_set("item").alias("items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, n_hit, items (sorted strings), contaminated."""
    windows = stage(benchmark_windows(benchmark, window).withColumn("wid", F.xxhash64("words")), "windows")
    # Every window's shingles with their places.
    sized = windows.select("wid", "words", F.least(F.size("words"), F.lit(SHINGLE)).alias("k"))
    placed = sized.select("wid", "words", "k", F.posexplode(_zipped(F.col("words"))).alias("place", "at"))
    placed = placed.filter(F.col("place") + F.col("k") <= F.size("words"))
    key = F.coalesce(*[F.when(F.col("k") == k, _shingle(F.col("at"), k)) for k in range(1, SHINGLE + 1)])
    shingles = stage(placed.select("wid", "words", "k", "place", key.alias("shingle")), "window-shingles")
    sizes = sorted(r["k"] for r in shingles.select("k").distinct().collect())  # at most SHINGLE rows
    wanted = small_side(shingles.select("shingle").distinct(), BROADCAST_ROWS)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = texts.withColumn("text_key", text_hash())
    # 1. positions of benchmark shingles
    spread = keyed.select("doc_id", "text_key", words_of(F.col("text")).alias("w"))
    spread = spread.select("doc_id", "text_key", F.size("w").alias("n"), F.posexplode(_zipped(F.col("w"))).alias("pos", "at"))
    if len(sizes) > 1:
        keys = F.explode(F.array(*[_shingle(F.col("at"), k) for k in sizes]))
    else:
        keys = _shingle(F.col("at"), sizes[0] if sizes else SHINGLE)
    hits = stage(spread.select("doc_id", "text_key", "n", "pos", keys.alias("shingle")).join(wanted, "shingle", "left_semi"), "shingle-hits")
    # 2. rarity order; the prefix of a window is its rarest shingle
    often = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = shingles.join(often, "shingle", "left").groupBy("wid", "words").agg(
        F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "shingle", "place")).alias("first")
    )
    prefix = ranked.filter("first.often > 0").select("wid", "words", "first.shingle", "first.place")
    prefix = prefix.join(windows.select("wid", "words", "items"), ["wid", "words"])
    # 3. candidate starts within the positional and length bounds
    near = hits.join(small_side(prefix, BROADCAST_ROWS), "shingle")
    start = F.col("pos") - F.col("place")
    near = near.select("doc_id", "text_key", start.alias("start"), "words", "items").filter(
        (F.col("start") >= 0) & (start + F.size("words") <= F.col("n"))
    )
    per_doc = near.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "words", "items")).alias("near"))
    # 4. exact verification against the words of the documents that have a candidate, each once; only
    # their texts meet the candidates, the others stay where they are
    per_doc = stage(per_doc, "candidates")
    same = lambda x, y: F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id")) & (F.col(f"{x}.text_key") == F.col(f"{y}.text_key"))
    asked = small_side(per_doc.select("doc_id", "text_key"), materialised=True)
    suspects = keyed.alias("d").join(asked.alias("a"), same("d", "a"), "left_semi").dropDuplicates(["doc_id", "text_key"])
    joined = suspects.alias("d").join(per_doc.alias("c"), same("d", "c")).select("d.doc_id", "d.text_key", words_of(F.col("d.text")).alias("w"), "c.near")
    # Stored, so that words are cut once and not for every candidate that looks at them.
    joined = stage(joined, "suspects")
    found = F.filter("near", lambda c: F.slice(F.col("w"), c["start"] + 1, F.size(c["words"])) == c["words"])
    checked = stage(joined.select("doc_id", "text_key", found.alias("found")), "verified").filter(F.size("found") > 0)
    covered = F.flatten(F.transform("found", lambda c: F.sequence(c["start"], c["start"] + F.size(c["words"]) - 1)))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda c: c["items"]))))
    hit = checked.select("doc_id", "text_key", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), items.alias("items"))
    rows = keyed.select("doc_id", "text_key", F.size(words_of(F.col("text"))).cast("long").alias("n_words")).alias("d")
    out = rows.join(hit.alias("h"), same("d", "h"), "left")
    return out.select(
        "d.doc_id", "d.text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
