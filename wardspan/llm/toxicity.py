"""Toxicity by a weighted grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech or
none. Small transducers, each for one pattern, are composed into one machine
that runs over the symbols of a clause and marks what it matched: an insult
aimed at somebody, a threat with its target, an insult negated or reported; an
insult that none of the first two takes up is bare. A clause scores by the
weight of its path through the machine, composed of the weights of the insult
and of all marks on the way: marks that raise it multiply the chance that the
clause is clean, bare and the marks that lower it the chance that it is toxic.
So an insult alone scores below the same insult aimed at somebody, and that
above the same negated. All weights are chances of the label learned from
labelled texts. A text takes the weight of its best clause, more of them
counting a little more.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count
from math import ceil, log

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.llm.words import NOT_ALNUM, UPPER
from wardspan.sources.stage import Scratch

#: Labelled rows that weights are learned from, about, however many there are.
LABELLED_ROWS = 20_000
#: Words and stems learned in a turn, at most.
A_TURN = 16
#: Letters of a stem.
STEM = 4
#: Reach of a target or a negation, in words.
REACH = 3

# The words the grammar knows without any label.
INSULTS = (
    "asshole bastard bitch clown coward cretin degenerate disgusting dumb dumbass filth fool freak idiot idiots imbecile "
    "jerk loser losers lowlife maggot moron morons parasite pathetic pig retard scum stupid subhuman trash ugly vermin "
    "worthless idiota estúpido imbécil basura pendejo idiote imbécile connard ordure débile idioten dummkopf abschaum "
    "versager arschloch"
).split()
THREATS = "kill murder hurt destroy burn stab shoot hang strangle beat smash exterminate matar matarte tuer töten umbringen".split()
TARGETS = (
    "you your yours yourself he him his she her they them their people tu te toi vous ton votre il elle ils du dich dir "
    "euch ihr er sie tú usted ustedes ti él ella ellos"
).split()
NEGATIONS = "not no never isn aren wasn don doesn didn ne pas jamais non kein keine nicht nie nunca jamás".split()
REPORTS = "said says say told called calls quoted quote wrote reported allegedly dit dijo sagte nannte schrieb llamó".split()

_TABLE = bytes.maketrans(NOT_ALNUM + UPPER.encode(), bytes(32 if not 65 <= b <= 90 else b + 32 for b in NOT_ALNUM) + UPPER.lower().encode())
_CLAUSE = re.compile(rb"[.!?;\n]+")
_OTHER, _INSULT, _THREAT, _TARGET, _NEGATION, _REPORT = range(6)
RAISING, LOWERING = ("aimed", "threat"), ("bare", "negated", "reported")


class Transducer:
    """States, arcs (state, symbol) -> (state, marks), and the state left by any other symbol."""

    def __init__(self, start, arcs: dict, rest: dict):
        self.start, self.arcs, self.rest = start, arcs, rest

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (self.rest.get(state, state), ())


def _within(first: int, second: int, mark: str) -> Transducer:
    """Marks ``second`` up to REACH symbols after ``first``; the state counts down."""
    arcs = {(s, first): (REACH, ()) for s in range(REACH + 1)}
    arcs |= {(s, second): (s - 1, (mark,)) for s in range(1, REACH + 1)}
    return Transducer(0, arcs, {s: max(0, s - 1) for s in range(REACH + 1)})


def _after(first: int, second: int, mark: str) -> Transducer:
    """Marks ``second`` anywhere after ``first`` in the clause."""
    return Transducer(0, {(0, first): (1, ()), (1, second): (1, (mark,))}, {})


def grammar() -> Transducer:
    """The composition of all patterns: one machine whose states are tuples of theirs."""
    parts = (
        _within(_TARGET, _INSULT, "aimed"),
        _within(_INSULT, _TARGET, "aimed"),
        _within(_THREAT, _TARGET, "threat"),
        _within(_NEGATION, _INSULT, "negated"),
        _within(_NEGATION, _THREAT, "negated"),
        _after(_REPORT, _INSULT, "reported"),
        _after(_REPORT, _THREAT, "reported"),
    )
    start = tuple(p.start for p in parts)
    arcs, open_ = {}, [start]
    seen = {start}
    while open_:
        state = open_.pop()
        for symbol in range(6):
            moves = [p.step(s, symbol) for p, s in zip(parts, state)]
            after = tuple(m[0] for m in moves)
            arcs[state, symbol] = after, tuple(x for m in moves for x in m[1])
            if after not in seen:
                seen.add(after)
                open_.append(after)
    return Transducer(start, arcs, {})


@dataclass
class Weights:
    """Chances of the label: by word, by stem (ends in *), by mark, and without any match."""

    terms: dict[str, float]
    marks: dict[str, float] = field(default_factory=lambda: {"aimed": 0.8, "threat": 0.9, "bare": 0.8, "negated": 0.2, "reported": 0.2})
    base: float = 0.05


class Scorer:
    """Runs the grammar over texts with given weights."""

    def __init__(self, weights: Weights):
        self.weights = weights
        self.words = {w.encode(): p for w, p in weights.terms.items() if w[-1] != "*"}
        self.stems = {w[:-1].encode(): p for w, p in weights.terms.items() if w[-1] == "*"}
        self.lengths = sorted({len(s) for s in self.stems})
        self.symbols = {w.encode(): s for ws, s in ((REPORTS, _REPORT), (NEGATIONS, _NEGATION), (TARGETS, _TARGET), (THREATS, _THREAT)) for w in ws}
        self.machine = grammar()
        self.threats = frozenset(w.encode() for w in THREATS)

    def term(self, word: bytes) -> float:
        """Weight of an insulting word, by itself or by its stem; 0 for any other."""
        best = self.words.get(word, 0.0)
        for n in self.lengths:
            if n < len(word) and (weight := self.stems.get(word[:n], 0.0)) > best:
                best = weight
        return best

    def clauses(self, text: str) -> list[tuple[float, frozenset[str]]]:
        """(best word weight, marks) of every clause with an insult or a threat."""
        raw = text.encode()
        every = set(raw.translate(_TABLE).split())
        insults = {w: p for w in every if (p := self.term(w))}
        if not insults and every.isdisjoint(self.threats):
            return []
        found, machine = [], self.machine
        for clause in _CLAUSE.split(raw):
            words = clause.translate(_TABLE).split()
            best, marks, state = 0.0, set(), machine.start
            for word in words:
                weight = insults.get(word, 0.0)
                state, made = machine.step(state, _INSULT if weight else self.symbols.get(word, _OTHER))
                best = max(best, weight)
                marks.update(made)
            if best and marks.isdisjoint(RAISING):
                marks.add("bare")
            if best or "threat" in marks:
                found.append((best, frozenset(marks)))
        return found

    def path(self, weight: float, marks: frozenset[str]) -> float:
        """The weight of a clause's path: of its best word and of all its marks, composed."""
        clean = 1 - weight
        for mark in RAISING:
            clean *= 1 - self.weights.marks[mark] if mark in marks else 1
        value = 1 - clean
        for mark in LOWERING:
            value *= self.weights.marks[mark] if mark in marks else 1
        return value

    def scored(self, text: str) -> tuple[float, int]:
        """The score of a text and the number of its matched clauses, of one scan."""
        matched = self.clauses(text)
        if not matched:
            return self.weights.base, 0
        best = more = 0.0
        for weight, marks in matched:
            value = self.path(weight, marks)
            best, more = max(best, value), more + value
        return 1 - (1 - best) / (1 + 0.1 * max(0.0, more - best)), len(matched)

    def score(self, text: str) -> float:
        return self.scored(text)[0]


def _terms(explained: Weights):
    """How many toxic and clean texts of the task hold each word and stem; toxic texts with a known insult don't count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        scorer = Scorer(explained)
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set(text.encode().translate(_TABLE).split())
                if toxic and any(map(scorer.term, found)):
                    continue
                words = {w.decode() for w in found}
                counts[toxic].update({*words, *(f"{w[:STEM]}*" for w in words if len(w) > STEM), ""})
        names = list(counts[0].keys() | counts[1].keys())
        for k in range(0, len(names), 50_000):
            part = names[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *(pa.array([counts[x][w] for w in part], pa.int64()) for x in (1, 0))],
                names=["term", "toxic", "clean"],
            )

    return run


def _marked(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = Scorer(weights), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matched = scorer.clauses(text or "")
                marks = {m for _, own in matched for m in own} | ({"none"} if not matched else set())
                counts.update((m, toxic) for m in marks)
        for (mark, toxic), n in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([mark]), pa.array([toxic], pa.int32()), pa.array([n], pa.int64())], names=["mark", "toxic", "n"]
            )

    return run


def fit_weights(labelled: DataFrame) -> Weights:
    """Weights from ``labelled`` (text, toxic 0 or 1), each distinct text once.

    Words and stems are taken in turns, those of most toxic texts first, where
    at least four in five texts that hold one are toxic and so many toxic texts
    would not come together by chance for any of the words counted. Later turns
    count only the toxic texts that hold none taken so far, so the other words
    of copied texts don't count as insults; turns end when no term passes. Of
    terms that share a stem one is taken in a turn. Rows with a null are left out;
    without labelled rows the known words stand.
    """
    scratch = Scratch(labelled.sparkSession)
    sample = labelled.where("toxic in (0, 1) and text is not null")
    sample = scratch.write(sample.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic")), "labelled")
    learned: dict[str, float] = {}
    terms = dict.fromkeys(INSULTS, 0.8)
    for turn in count():
        counts = sample.mapInArrow(_terms(Weights(learned)), "term string, toxic long, clean long")
        counts = scratch.write(
            counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "counts"
        )
        size = counts.where("term = ''").first()
        if turn == 0:
            for term, a, b in counts.where(F.col("term").isin(*INSULTS)).collect():
                terms[term] = (4 + a) / (5 + a + b)
        if not size or not size["toxic"] or not size["clean"]:
            break
        chance = size["toxic"] / (size["toxic"] + size["clean"])
        least = ceil(log(0.5 / max(1, counts.where("toxic + clean >= 3").count())) / log(chance))
        best = counts.where((F.col("toxic") >= max(4, least)) & (F.col("toxic") >= 4 * F.col("clean")))
        best = best.where(~F.col("term").isin("", *TARGETS, *NEGATIONS, *REPORTS))
        new: dict[str, float] = {}
        worth = F.desc(F.col("toxic") - 4 * F.col("clean"))
        for term, a, b in best.orderBy(worth, F.col("term").endswith("*"), "term").limit(20 * A_TURN).collect():
            if len(new) < A_TURN and all(w[:STEM] != term[:STEM] for w in new):
                new[term] = (a + 0.5) / (a + b + 1)
        if not new:
            break
        learned |= new
    terms |= learned
    weights = Weights(terms)
    seen = Counter()
    for mark, label, n in (
        sample.mapInArrow(_marked(weights), "mark string, toxic int, n long").groupBy("mark", "toxic").agg(F.sum("n")).collect()
    ):
        seen[mark, label] += n
    for mark, chance in weights.marks.items():  # each starts as five texts' worth of its first value
        a, b = seen[mark, 1], seen[mark, 0]
        weights.marks[mark] = (a + 5 * chance) / (a + b + 5)
    a, b = seen["none", 1], seen["none", 0]
    weights.base = min(0.45, (a + 0.5) / (a + b + 10))
    scratch.drop()
    return weights


def score_toxicity(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``<text_col>``, score, predicted, clauses.

    ``score`` (0 to 1) is higher where the label is likelier, ``predicted`` is 1
    from 0.5 on, ``clauses`` the number of matched clauses. Null and empty texts
    score as texts without a match. Equal texts score alike; null ids and
    repeated rows are kept; other columns are ignored; an empty table gives no
    rows. Whole texts are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            scores, counts = zip(*map(scorer.scored, texts)) if texts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(counts, pa.int64()),
                ],
                names=["id", "text", "score", "predicted", "clauses"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(run, f"id {kind}, text string, score double, predicted int, clauses long")
    return rows.withColumnsRenamed({"id": id_col, "text": text_col})


def score_column(text_col: str, weights: Weights) -> Column:
    """The score of a text column, as in ``score_toxicity``."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(weights)
        for texts in batches:
            yield pd.Series([scorer.score(t if isinstance(t, str) else "") for t in texts], dtype="float64")

    return scored(F.col(f"`{text_col}`"))


def labelled_texts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", rows: int = LABELLED_ROWS) -> DataFrame:
    """(text, toxic) of about ``rows`` labelled rows to learn from.

    They are rows whose crc32 of the id as text is not 0 modulo 5, those with
    the least hash. As their number is bounded, they are broadcast to the texts.
    """
    name = F.col("id").cast("string")
    known = labels.select(F.col(f"`{key}`").alias("id"), "toxic").where("toxic in (0, 1) and id is not null")
    known = known.where(F.crc32(name.cast("binary")) % 5 != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, rows / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64(name), F.lit(1 << 20)) < F.lit(int((1 << 20) * share)))
    return docs.select(F.col(f"`{key}`").alias("id"), "text").join(F.broadcast(known), "id").select("text", "toxic")
