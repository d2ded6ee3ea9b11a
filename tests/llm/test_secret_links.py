"""Secret spans against brute force: the fixed patterns by plain scanning, links by all pairs of a scope."""

import random
import re
import time

import pytest

from wattage.llm import secrets


def brute_base(text):
    """The three fixed patterns, leftmost non-overlapping, failing matches dropped."""
    out = []
    assign = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)")
    for kind, pattern, group, least in (("assign", assign, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return out


def brute_spans(text, reach):
    """Every pair of parts of a scope."""
    base = brute_base(text)
    weak = [(m.start(), "identifier", m.end()) for m in secrets.IDENTIFIER.finditer(text)]
    weak += [(m.start(), "endpoint", m.end()) for m in secrets.ENDPOINT.finditer(text)]
    weak += [(m.start(), "random", m.end()) for m in secrets.RANDOM.finditer(text) if secrets._random(m[0])]
    apart = lambda x, y: x[2] <= y[0] or y[2] <= x[0]
    weak = [w for w in weak if all(apart(w, t) for t in base + [v for v in weak if v[1] == "endpoint" and v != w])]
    breaks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = lambda s: sum(b <= s[0] for b in breaks)

    def near(part, role):
        others = [o for o in base + weak if o != part and secrets.ROLE[o[1]] == role and scope(o) == scope(part)]
        return any(reach is None or max(o[0] - part[2], part[0] - o[2]) <= reach for o in others)

    wants = {"identifier": ("secret",), "random": ("identifier",), "endpoint": ("identifier", "secret")}
    found = base + [w for w in weak if all(near(w, r) for r in wants[w[1]])]
    return sorted(found, key=lambda s: (s[0], secrets.KINDS.index(s[1])))


PIECES = [
    "user=reader", "client_id: svc", "login = 'ab'", "https://h.example/x", "postgres://h/db", "aB3dE5gH7jK9mN1pQ3rS5tU7", "AKIA" + "Q" * 16, "AKIAQ", "password=hunter22",
    "PassWd : 'x'", "api_key=0123456789abcdef01234567", "0123456789abcdef" * 2, "secret", "some words", "\n", "\n\n", "\n \t\n", "é日", "token=https://h/p?user=reader", " filler" * 40,
]


@pytest.mark.parametrize("reach", [None, 200, 10])
def test_spans_brute_force(documents, reach):
    rng = random.Random(6)
    texts = [rng.choice(["", " "]).join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14))) for _ in range(300)] + ["", None]
    got = {r["doc_id"]: r for r in secrets.find_secrets(documents(list(enumerate(texts))).repartition(3), reach=reach).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert [(s["start"], s["kind"], s["end"]) for s in got[i]["base"]] == sorted(brute_base(text or ""), key=lambda s: (s[0], secrets.KINDS.index(s[1])))
        assert [(s["start"], s["kind"], s["end"]) for s in got[i]["spans"]] == brute_spans(text or "", reach)


def test_parts_of_one_scope_link_however_far_apart(documents):
    text = "DB_USER=reader " + "words " * 500 + "aB3dE5gH7jK9mN1pQ3rS5tU7"
    rows = documents([(1, text), (2, text.replace("words words", "words\n\nwords", 1))])
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.find_secrets(rows, reach=None).collect()}
    assert got == {1: ["identifier", "random"], 2: []}


def test_overlaps_are_looked_up_in_order():
    """Twice the spans take about twice the time, not four times."""
    seconds = []
    for n in (2_000, 8_000):
        text = "".join(f"user=reader{i} password=hunter{i} https://h/{i} \n" for i in range(n))
        base = secrets.base_spans(text)
        begin = time.process_time()
        secrets.weak_spans(text, base)
        seconds.append(time.process_time() - begin)
    assert seconds[1] < 10 * seconds[0]


def test_texts_without_weak_parts_are_not_dealt_out(spark, documents, tmp_path):
    """They keep their base spans where they were found: no shuffle, so no partition (and file) for each hash of their keys."""
    plain = [(i, [f"password=hunter{i}", "some words", "", None][i % 4]) for i in range(400)]
    linked = [(1_000, "DB_USER=reader aB3dE5gH7jK9mN1pQ3rS5tU7"), (1_000, "DB_USER=reader aB3dE5gH7jK9mN1pQ3rS5tU7"), (1_001, "DB_USER=reader"), (None, "login=reader token=abcdefgh")]
    texts = plain + linked + [(1_002, "token=abcdefgh"), (1_002, "token=abcdefgh"), (None, "token=abcdefgh")]
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        secrets.find_secrets(documents(texts).repartition(3), reach=None).write.parquet(f"{tmp_path}/out")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "out").glob("part-*.parquet"))) < 20
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    got = sorted((str(r["doc_id"]), [(s["start"], s["kind"], s["end"]) for s in r["base"]], [(s["start"], s["kind"], s["end"]) for s in r["spans"]]) for r in rows)
    order = lambda spans: sorted(spans, key=lambda s: (s[0], secrets.KINDS.index(s[1])))
    assert got == sorted((str(i), order(brute_base(t or "")), brute_spans(t or "", None)) for i, t in texts)
