"""Secret scan: patterns, and multipart credentials linked by position.

Base kinds (assign, access, hex) are reported wherever they match. Weak kinds say little
alone: an identifier (client_id = ...), an endpoint (a URL) and a token that looks random.
They are reported only where complementary parts stand together. Parts are linked by an
interval join within a scope (the text between blank lines): a part joins its nearest
complement in the scope, wherever it stands, or with ``reach`` only if the gap between them
is at most so many code points. The join is a sweep over the parts of a scope in order of
position, which finds each part's nearest neighbour of every role and makes no pairs.

* an identifier is reported if a secret (base or random) is in reach;
* a random token is reported if an identifier is in reach;
* an endpoint is reported if both an identifier and a secret are in reach.

Positions count code points, ends are exclusive. A null text is empty. Repeated rows get
a row each. Only doc_id and text are read.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage, text_hash

# Fixed patterns of the base kinds; letters of the first group in either case (ASCII).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
#: The same matches as HEX of HEX_LEAST characters or more: runs are maximal either way.
HEX_LONG = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "key")
# Weak kinds.
# A name may follow "_" or "-" (DB_USER=); a token may follow "=" (KEY=value).
IDENTIFIER = re.compile(r"""(?<![A-Za-z0-9])(?:client_?id|access_?key_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""", re.IGNORECASE | re.ASCII)
IDENTIFIER_HINTS = ("id", "user", "login", "account")
ENDPOINT = re.compile(r"\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
RANDOM_BITS = 3.5
KINDS = ("assign", "access", "hex", "identifier", "random", "endpoint")
ROLE = {"assign": "secret", "hex": "secret", "random": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}
REACH = 200
TEXTS_AT_ONCE = 1_000

_BLANK = re.compile(r"\n[ \t\r]*\n")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base kinds."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [(m.start(), "hex", m.end()) for m in HEX_LONG.finditer(text)]
    return out


def _random(token: str) -> bool:
    counts = Counter(token)
    bits = -sum(c / len(token) * math.log2(c / len(token)) for c in counts.values())
    return bits >= RANDOM_BITS and any(c.isdigit() for c in token) and any(c.isupper() for c in token) and any(c.islower() for c in token)


def weak_spans(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the weak kinds that do not overlap a base span."""
    low = text.lower()
    out = []
    if any(h in low for h in IDENTIFIER_HINTS) and (":" in low or "=" in low):
        out += [(m.start(), "identifier", m.end()) for m in IDENTIFIER.finditer(text)]
    if "://" in text:
        out += [(m.start(), "endpoint", m.end()) for m in ENDPOINT.finditer(text)]
    out += [(m.start(), "random", m.end()) for m in RANDOM.finditer(text) if _random(m[0])]
    based = _Covered([(a, b) for a, _, b in base])
    taken = _Covered([(a, b) for a, _, b in base] + [(a, b) for a, k, b in out if k == "endpoint"])
    return [(a, k, b) for a, k, b in out if not (based if k == "endpoint" else taken).meets(a, b)]


class _Covered:
    """The union of spans as disjoint runs in order, so that a look-up is a bisection."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        at = bisect.bisect_left(self.starts, b) - 1  # the last run that starts before b
        return at >= 0 and self.ends[at] > a


SPAN = "struct<start:int,kind:string,end:int>"
PART = "struct<start:int,kind:string,end:int,scope:int>"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
    part = pa.struct([*span, pa.field("scope", pa.int32())])
    for batch in slices(batches, TEXTS_AT_ONCE):
        bases, parts = [], []
        for text in batch.column(2).to_pylist():
            text = text or ""
            base = base_spans(text)
            weak = weak_spans(text, base)
            bases.append([dict(zip(("start", "kind", "end"), s)) for s in base])
            if weak:  # only then can a link add a span
                breaks = [m.start() for m in _BLANK.finditer(text)]
                parts.append([{"start": a, "kind": k, "end": b, "scope": bisect.bisect(breaks, a)} for a, k, b in base + weak])
            else:
                parts.append([])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(bases, pa.list_(span)), pa.array(parts, pa.list_(part))], names=["doc_id", "text_key", "base", "parts"]
        )


def link_parts(parts: DataFrame, reach: int | None = REACH) -> DataFrame:
    """Interval join of parts (doc_id, text_key, scope, start, kind, end): adds the gaps ``to_identifier``,
    ``to_secret`` and ``to_endpoint`` to the nearest other part of each role, null beyond ``reach`` (None: anywhere in the scope)."""
    role = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in ROLE.items()])
    rows = parts.withColumn("role", role)
    w = Window.partitionBy("doc_id", "text_key", "scope").orderBy("start", "end", "kind")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    for r in ("identifier", "secret", "endpoint"):
        back = F.col("start") - F.max(F.when(F.col("role") == r, F.col("end"))).over(before)
        ahead = F.min(F.when(F.col("role") == r, F.col("start"))).over(after) - F.col("end")
        gap = F.greatest(F.least(back, ahead), F.lit(0))  # least() skips nulls; overlapping parts have gap 0
        gap = F.when(F.least(back, ahead).isNotNull(), gap)
        rows = rows.withColumn(f"to_{r}", gap if reach is None else F.when(gap <= reach, gap))
    return rows


def find_secrets(docs: DataFrame, reach: int | None = REACH) -> DataFrame:
    """One row per document row: doc_id, base and spans (arrays of start, kind, end in order)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", text_hash().alias("text_key"), "text")
    found = stage(texts.mapInArrow(_extract, f"doc_id long, text_key long, base array<{SPAN}>, parts array<{PART}>"), "secret-parts")
    parts = found.filter(F.size("parts") > 0).select("doc_id", "text_key", F.explode("parts").alias("p"))
    parts = parts.select("doc_id", "text_key", "p.scope", "p.start", "p.kind", "p.end").distinct()
    linked = link_parts(parts, reach)
    kind, near = F.col("kind"), lambda r: F.col(f"to_{r}").isNotNull()
    reported = linked.filter(
        ((kind == "identifier") & near("secret"))
        | ((kind == "random") & near("identifier"))
        | ((kind == "endpoint") & near("identifier") & near("secret"))
    )
    added = reported.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    added = added.select(F.col("doc_id").alias("a_id"), F.col("text_key").alias("a_key"), "added")
    # Most documents have no part to link: they keep their base spans and cross no shuffle or sort.
    alone = found.filter(F.size("parts") == 0).select("doc_id", "text_key", "base", F.col("base").alias("spans"))
    some = found.filter(F.size("parts") > 0).join(added, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_key") == F.col("a_key")), "left")
    spans = F.concat("base", F.coalesce("added", F.expr(f"cast(array() as array<{SPAN}>)")))
    rows = alone.unionByName(some.select("doc_id", "text_key", "base", spans.alias("spans")))
    return rows.select("doc_id", "text_key", _ordered(F.col("base")).alias("base"), _ordered(F.col("spans")).alias("spans"))


def _ordered(spans: F.Column) -> F.Column:
    """By start, then kind as listed."""
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_sort(keyed)


def spans_text(spans: F.Column | str) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
