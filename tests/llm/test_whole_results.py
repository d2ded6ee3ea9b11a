"""Nothing is lost in silence: rows that share an id, articles in wrappers, files of an archive."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wattage.llm import html_text, token_files, topk, warc
from wattage.llm.queries import held_out


@pytest.mark.parametrize("shard,fan", [(8_192, 16), (8, 2)])
def test_every_row_is_a_candidate_whatever_its_id(spark, monkeypatch, shard, fan):
    monkeypatch.setattr(topk, "FAN", fan)
    rng = random.Random(4)
    rows = [(rng.randrange(60), [rng.choice([-1.0, 0.5, 1.0, 2.0]) for _ in range(3)]) for _ in range(120)] + [(1, [1.0, 1.0, 1.0]), (1, [9.0, 9.0, 9.0]), (None, [9.0] * 3)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, row long, shard int").repartition(3)
    got = topk.top_k(topk.quantised(df, one_per_id=False), F.col("vec_id") % 20 == 0, 20, shard_rows=shard, tile_rows=4)
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None]
    want = []
    for at, (i, q) in enumerate(whole):
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, c)), j) for other, (j, c) in enumerate(whole) if other != at)[:20]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)


STORY = "".join(f"<p>Sentence {i} of a story that goes on for a good while, with commas and all.</p>" for i in range(6))
TEXT = " ".join(f"Sentence {i} of a story that goes on for a good while, with commas and all." for i in range(6))


@pytest.mark.parametrize("page", [
    f"<body><form id=aspnetForm><div class=nav>Home</div><article>{STORY}</article><input><label>Search</label></form></body>",
    f"<body><div class='page newsletter-enabled'><nav>Home</nav><article>{STORY}</article><footer>End</footer></div></body>",
    f"<body><div id=cookie-wrapper><main>{STORY}</main></div><div class=comments><article class=comment-body><p>I say, what a story, again.</p></article></div></body>",
    f"<body><nav>Home</nav><form action=/><div>{STORY}</div><label>Your name</label><select><option>One</option></select><button>Go</button></form><footer>End</footer></body>",
    f"<body><div class='modal-ready share-bar'><div class=text>{STORY}</div></div></body>",
    f"<body><article>{STORY}<form><label>Mail</label><p>Subscribe to get more stories like this one.</p></form></article></body>",
    f"<body><div>{STORY}</div><div class=newsletter><p>Get our letter each week.</p></div><form><p>Search the site.</p><label>Words</label></form></body>",
])
def test_no_article_is_lost_in_a_wrapper(page):
    assert html_text.main_text(page) == TEXT


def test_comments_and_teasers_are_no_articles():
    page = f"<body><article>{STORY}</article><ol class=commentlist><li><article><p>A reader's comment that is long enough to look like text.</p></article></li></ol>"
    page += "<div class='related posts'><article><p>Another story entirely, with its own teaser text here.</p></article></div></body>"
    assert html_text.main_text(page) == TEXT
    assert html_text.main_text(f"<body><div>{STORY}</div><article class=cookie><p>We use cookies here.</p></article></body>") == TEXT


def _written(spark, kind):
    folder = warc.shared_folder(spark, "test-files")
    if kind == "warc":
        pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 20) for i in range(40)], "page_id long, url string, html string").repartition(4)
        return folder, warc.write_archives(pages, folder, 0, 400), warc.read_archives
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string").repartition(4)
    return folder, token_files.write_token_files(docs, folder, 2, file_ids=20), token_files.read_token_files


@pytest.mark.parametrize("kind", ["warc", "ids"])
def test_readers_refuse_missing_changed_and_unnamed_files(spark, kind):
    import pathlib
    import shutil

    folder, manifest, read = _written(spark, kind)
    assert read(spark, folder, manifest).count() == 40
    root = pathlib.Path(folder.removeprefix("file:"))
    assert (root / "_manifest").is_dir()  # committed beside the data
    file = sorted(p for p in root.iterdir() if p.is_file() and not p.name.startswith((".", "_")))[1]
    whole = file.read_bytes()
    (root / f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(whole[:-9] + bytes([whole[-9] ^ 1]) + whole[-8:])
    with pytest.raises(Exception, match="differs from the manifest"):
        read(spark, folder, manifest).collect()
    file.write_bytes(whole)
    shutil.copy(file, root / f"part-999999-00000{file.name[file.name.index('.'):]}")
    with pytest.raises(ValueError, match="part-999999-00000.* is not named"):
        read(spark, folder, manifest)
    (root / f"part-999999-00000{file.name[file.name.index('.'):]}").unlink()
    file.unlink()
    with pytest.raises(ValueError, match=f"{file.name} is missing"):
        read(spark, folder, manifest)


def test_a_null_id_is_not_held_out(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,), (3,)], "doc_id long").select(held_out(F.col("doc_id")).alias("h")).collect()
    assert rows[0]["h"] is False and all(r["h"] is not None for r in rows)
