"""Toxicity by a weighted finite-state grammar over clauses.

Lexical transducers map words to classes: insult (with a weight), threat, target,
negation, reported speech. Clause transducers for target, negation and reported speech
run side by side (their composition is the product of their states), and an insult or
threat that arrives in a state is emitted with the weight that state gives it: it counts
more towards a target, little when just negated, less when reported. A document's score
is a logistic function of the sum of its clause weights: a listed insult alone needs a target,
and what is negated or reported lifts a score only up to a bound under 0.7, however often it
occurs. A learned entry may be so sure a sign that one clause with it crosses 0.7 without a
target; in corpora like that the clause states change few decisions.

The insult lexicon is learned from labelled rows: words and word stems whose documents
are toxic beyond what chance explains (the lower bound of the toxic share). Of the many
candidates (a toxic text that was copied makes all of its words look toxic) those stay
that are among the best in several toxic documents. At most ``SAMPLE_ROWS`` labelled rows
are used, the first in an order by hash. A short general list of English insults is
part of the grammar too, each word as far as the labelled rows do not speak against it.
A threat word is judged by the clauses that make a threat of it (with a target, neither
negated nor reported), whatever else the word is used for.

A null or empty text has no clause and gets the lowest score. A null label is no label;
a document with several labels counts as toxic if one says so. Repeated rows are scored
alike. Only doc_id and text are read, and the id is no input of the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stage

#: Labelled rows used for learning (a bounded sample, in an order by hash).
SAMPLE_ROWS = 50_000
#: Entries of the learned lexicon, and of its candidates (bounds of the model, not of the corpus). Beyond
#: them the least sure candidates and the least credited entries are not learned; words they alone would
#: have marked then count only if the general list has them.
LEXICON_ENTRIES = 5_000
CANDIDATES = 20_000
STEM = range(4, 9)
MIN_SUPPORT = 5
MIN_CREDIT = 3
SHARE_BOUND = 0.6
BIAS = 2.1
#: Sum of weights up to which negated and reported insults and threats count (a score of 0.69).
SOFT_SUM = BIAS + 0.8
TEXTS_AT_ONCE = 1_000

# Fixed word lists of the grammar (general language; the learned lexicon comes on top).
INSULTS = """arsehole asshole bastard bitch clown coward creep cretin degenerate dimwit disgusting dumbass filth
filthy fool freak garbage hideous idiot idiotic imbecile jerk loser lowlife maggot moron moronic parasite
pathetic pig prick repulsive retard rotten scum scumbag sleazy slob stupid swine trash ugly vermin vile
worthless wretch""".split()
THREATS = """kill murder destroy hurt beat shoot stab burn hang strangle crush smash punish bury drown
töten umbringen schlagen tuer frapper détruire matar golpear destruir""".split()
TARGETS = """you your yours yourself u ur they them their he him she her these those people du dich dir dein deine
ihr euch tu te toi ton ta vous votre tú usted ustedes vosotros""".split()
NEGATIONS = """not never no nobody isn wasn aren don doesn didn nicht kein keine keinen niemals nie ne pas jamais
aucun aucune nunca jamás ningún ninguna""".split()
REPORTS = """said says say saying called calls call wrote writes quoted quotes claimed claims told alleged reportedly
sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó""".split()
#: Under BIAS + 0.84 (a score of 0.7) as it stands, over it with a target.
INSULT_WEIGHT = 2.5
THREAT_WEIGHT = 3.0

_LETTERS = re.compile(r"[^\W\d_]+")
_CLAUSES = re.compile(r"[^.!?;\n]+")
_TOKEN = re.compile(r"[^\W\d_]+n['’]t(?![^\W\d_])|[^\W\d_]+|[\"“”«»„,]")


@dataclass(frozen=True)
class Transducer:
    """A finite-state transducer over word classes: arcs (state, class) -> state, a weight factor per state."""

    arcs: dict
    factor: dict
    otherwise: dict  # state after any other class (default: unchanged)

    def step(self, state: int, symbol: str) -> int:
        return self.arcs.get((state, symbol), self.otherwise.get(state, state))


TARGET = Transducer({(0, "target"): 1}, {0: 1.0, 1: 1.3}, {})
# The state counts down the words a negation reaches, up to a comma: "not an idiot", "you can't, idiot".
NEGATION = Transducer({(s, "negation"): 2 for s in range(3)} | {(s, "comma"): 0 for s in range(3)}, {0: 1.0, 1: 0.2, 2: 0.2}, {2: 1, 1: 0})
# A verb of saying opens reported speech; inside quotation marks it counts for least.
REPORTED = Transducer({(0, "report"): 1, (1, "quote"): 2, (2, "quote"): 0}, {0: 1.0, 1: 0.6, 2: 0.3}, {})
GRAMMAR = (TARGET, NEGATION, REPORTED)


def clause_weight(symbols: list[tuple[str, float]]) -> tuple[float, float]:
    """Weight of a clause given as (class, weight) symbols, through the composed transducers, and
    the part of it that is negated or reported.

    An insult is emitted where it stands; a threat only if the clause has a target. The
    target factor is that of the clause's end, as the target may follow.
    """
    states = [0] * len(GRAMMAR)
    insults, threats = [0.0, 0.0], [0.0, 0.0]  # as they stand, negated or reported
    for symbol, weight in symbols:
        if symbol in ("insult", "threat"):
            factor = math.prod(t.factor[s] for t, s in zip(GRAMMAR[1:], states[1:]))
            (insults if symbol == "insult" else threats)[any(states[1:])] += weight * factor
        states = [t.step(s, symbol) for t, s in zip(GRAMMAR, states)]
    target = TARGET.factor[states[0]]
    plain, soft = (i * target + (t if states[0] else 0.0) for i, t in zip(insults, threats))
    return plain + soft, soft


def threats_made(symbols: list[tuple[str, object]]) -> set:
    """The threats of a clause, given as (class, word), that stand in the pattern: with a target, not negated or reported."""
    states, found = [0] * len(GRAMMAR), set()
    for symbol, word in symbols:
        if symbol == "threat" and not any(states[1:]):
            found.add(word)
        states = [t.step(s, symbol) for t, s in zip(GRAMMAR, states)]
    return found if states[0] else set()


class Grammar:
    """The lexical transducers compiled into one automaton, and the scoring of texts."""

    def __init__(self, learned: list[tuple[str, float]]) -> None:
        import ahocorasick

        words = {f"{w}$": ("insult", INSULT_WEIGHT) for w in INSULTS} | {f"{w}$": ("threat", THREAT_WEIGHT) for w in THREATS}
        for entry, weight in learned:  # what was learned replaces the listed weight
            words[entry] = (words.get(entry, ("insult",))[0], weight)
        self.words = words = {e: c for e, c in words.items() if c[1] > 0}
        self.other = {w: "target" for w in TARGETS} | {w: "negation" for w in NEGATIONS} | {w: "report" for w in REPORTS}
        self.find = ahocorasick.Automaton()
        for entry in words:
            self.find.add_word(entry.removesuffix("$"), len(entry.removesuffix("$")))
        self.find.make_automaton()
        self.stems = sorted({len(e) for e in words if not e.endswith("$")}, reverse=True)

    def _class(self, word: str) -> tuple[str, float]:
        known = self.words.get(f"{word}$")
        if known is None:
            for n in self.stems:
                if len(word) >= n and word[:n] in self.words:
                    known = self.words[word[:n]]
                    break
        return known or (self.other.get(word, "word"), 0.0)

    def threats(self, text: str | None) -> set[str]:
        """The threat words that some clause of the text makes a threat of."""
        return {w for _, _, tokens in self._marked(text) for w in threats_made([(self._symbol(t)[0], t) for t in tokens])}

    def _symbol(self, token: str) -> tuple[str, float]:
        if token.isalpha():
            return self._class(token)
        return ("negation" if len(token) > 1 else "comma" if token == "," else "quote", 0.0)

    def clauses(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, weight) of every clause with a weight, in code points."""
        return [(a, b, w) for a, b, w, _ in self.weighed(text)]

    def weighed(self, text: str | None) -> list[tuple[int, int, float, float]]:
        """The same, and the part of each weight that is negated or reported."""
        found = [(a, b, *clause_weight([self._symbol(t) for t in tokens])) for a, b, tokens in self._marked(text)]
        return [f for f in found if f[2] > 0]

    def _marked(self, text: str | None) -> list[tuple[int, int, list[str]]]:
        """(start, end, tokens) of every clause with an entry of the lexicon."""
        if not text:
            return []
        low = text.lower()
        if len(low) != len(text):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        hits = []
        for last, size in self.find.iter(low):
            first = last - size + 1
            if not first or not low[first - 1].isalpha():
                hits.append(first)
        if not hits:
            return []
        out, h = [], 0
        hits.sort()
        for m in _CLAUSES.finditer(low, 0):
            while h < len(hits) and hits[h] < m.start():
                h += 1
            if h == len(hits):
                break
            if hits[h] < m.end():
                out.append((m.start(), m.end(), _TOKEN.findall(low, m.start(), m.end())))
        return out


def total(weights: list[tuple[float, float]]) -> float:
    """Sum of a document's clause weights, given with their negated or reported parts: these lift it to SOFT_SUM at most."""
    plain, soft = sum(w - s for w, s in weights), sum(s for _, s in weights)
    return plain + min(soft, max(0.0, SOFT_SUM - plain))


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


def share_bound(toxic: int, clean: int, z: float = 1.64) -> float:
    """Lower bound (Wilson) of the toxic share of an entry's documents."""
    n = toxic + clean
    p = toxic / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def listed_weight(toxic: int, clean: int) -> float:
    """Weight of a listed word after ``toxic`` and ``clean`` documents with it: the listed
    weight counts as much as four toxic documents would; 0 under a weight of 1."""
    prior = 4.0
    against = prior / math.exp(INSULT_WEIGHT)
    weight = min(INSULT_WEIGHT, math.log((toxic + prior) / (clean + against)))
    return weight if weight >= 1 else 0.0


def threat_weight(toxic: int, clean: int) -> float:
    """Weight of a threat after ``toxic`` and ``clean`` documents with a clause that makes it:
    alone it scores the toxic share of these, with a prior of four toxic ones; 0 under a weight of 1."""
    prior = 4.0
    against = prior / math.exp(THREAT_WEIGHT)
    weight = min(THREAT_WEIGHT, BIAS + math.log((toxic + prior) / (clean + against)))
    return weight if weight >= 1 else 0.0


def _threats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic documents, clean documents) by threats made, summed."""
    grammar, seen = _grammar(()), Counter()
    for batch in slices(batches, TEXTS_AT_ONCE):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen.update((w, toxic) for w in grammar.threats(text))
    words = list({w for w, _ in seen})
    yield pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array([seen[w, 1] for w in words], pa.int64()), pa.array([seen[w, 0] for w in words], pa.int64())],
        names=["word", "toxic", "clean"],
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic documents, clean documents), partly summed."""
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = list({w for w, _ in seen})
        out = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([seen[w, 1] for w in words], pa.int64()), pa.array([seen[w, 0] for w in words], pa.int64())],
            names=["word", "toxic", "clean"],
        )
        seen.clear()
        return out

    for batch in slices(batches, TEXTS_AT_ONCE):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen.update((w, toxic) for w in set(_LETTERS.findall((text or "").lower())))
        if len(seen) > 200_000:
            yield flush()
    yield flush()


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: F.Column | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents for which ``usable`` (on doc_id) holds."""
    marked = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.filter(F.col("labelled").isNotNull() & F.col("toxic").isNotNull())
    if usable is not None:
        marked = marked.withColumnRenamed("labelled", "doc_id").filter(usable).withColumnRenamed("doc_id", "labelled")
    marked = marked.groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    sample = marked.orderBy(F.xxhash64("labelled"), "labelled").limit(rows)  # bounded: 12 bytes a row
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled")).select("text", "toxic")


def learn_lexicon(sample: DataFrame) -> list[tuple[str, float]]:
    """Weighted entries (a word as ``word$``, a stem as it is) from rows (text, toxic 0/1)."""
    sample = stage(sample.select("text", "toxic"), "toxicity-sample")
    words = sample.mapInArrow(_counts, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    words = stage(words, "toxicity-words")
    whole = words.select(F.concat("word", F.lit("$")).alias("entry"), "toxic", "clean")
    stems = F.explode(F.array([F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in STEM]))
    stems = words.select(stems.alias("entry"), "toxic", "clean").filter("entry is not null")
    stems = stems.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n, p, z2 = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean")), 1.64**2
    bound = (p + z2 / (2 * n) - 1.64 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    pure = whole.union(stems).filter(F.col("toxic") >= MIN_SUPPORT).withColumn("bound", bound).filter(F.col("bound") >= SHARE_BOUND)
    best = pure.orderBy(F.col("bound").desc(), F.length("entry").desc(), "entry").limit(CANDIDATES).collect()
    rank = {r["entry"]: i for i, r in enumerate(best)}
    sizes = sorted({len(e) for e in rank if not e.endswith("$")}, reverse=True)

    def credit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: Counter = Counter()
        for batch in slices(batches, TEXTS_AT_ONCE):
            for text in batch.column(0).to_pylist():
                found = set()
                for word in set(_LETTERS.findall((text or "").lower())):
                    forms = [f"{word}$", *(word[:n] for n in sizes if len(word) >= n)]
                    known = [rank[f] for f in forms if f in rank]
                    if known:
                        found.add(min(known))
                given.update(sorted(found)[:3])
        yield pa.RecordBatch.from_arrays([pa.array(list(given), pa.int64()), pa.array(list(given.values()), pa.int64())], names=["rank", "credit"])

    credits = sample.filter("toxic = 1").select("text").mapInArrow(credit, "rank long, credit long").groupBy("rank").agg(F.sum("credit").alias("credit"))
    kept = credits.filter(F.col("credit") >= MIN_CREDIT).orderBy(F.col("credit").desc(), "rank").limit(LEXICON_ENTRIES).collect()
    # Listed words keep their weight only as far as the labels bear it out (in a corpus of
    # several languages an insult of one may be an everyday word of another).
    listed = {r["word"]: listed_weight(r["toxic"], r["clean"]) for r in words.filter(F.col("word").isin(INSULTS)).collect()}
    made = sample.mapInArrow(_threats, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    listed |= {r["word"]: threat_weight(r["toxic"], r["clean"]) for r in made.collect()}
    found = {best[r["rank"]]["entry"]: math.log(best[r["rank"]]["bound"] / (1 - best[r["rank"]]["bound"])) for r in kept}
    found = {e: x for e, x in found.items() if e.removesuffix("$") not in THREATS or not e.endswith("$")}
    return list(({f"{w}$": x for w, x in listed.items()} | found).items())


_GRAMMARS: dict = {}


def _grammar(learned: tuple) -> Grammar:
    if learned not in _GRAMMARS:
        _GRAMMARS.clear()
        _GRAMMARS[learned] = Grammar(list(learned))
    return _GRAMMARS[learned]


def score_toxicity(docs: DataFrame, lexicon: list[tuple[str, float]], carry: str | None = None) -> DataFrame:
    """One row per document row: doc_id, score, clauses (start, end, weight); and column ``carry`` as it is."""
    learned = tuple(sorted(lexicon))
    clause = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())])
    kept = [carry] if carry else []

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = _grammar(learned)
        for batch in slices(batches, TEXTS_AT_ONCE):
            found = [grammar.weighed(t) for t in batch.column(1).to_pylist()]
            scores = [logistic(total([x[2:] for x in f]) - BIAS) for f in found]
            rows = [[{"start": a, "end": b, "weight": w} for a, b, w, _ in f] for f in found]
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(rows, pa.list_(clause)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "clauses", *kept])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *kept)
    spans = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add("weight", "double"))
    schema = T.StructType().add("doc_id", "long").add("score", "double").add("clauses", spans)
    for c in kept:
        schema = schema.add(c, docs.schema[c].dataType)
    return texts.mapInArrow(score, schema)
