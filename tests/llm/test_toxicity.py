import random
import zlib

import pytest

from helpers import documents
from wardspan.llm.queries import op3_toxicity
from wardspan.llm.toxicity import INSULTS, REACH, Scorer, Weights, fit_weights, grammar, labelled_texts, score_toxicity

FOLDER = "/root/testdata/sf0.01"
SCORER = Scorer(Weights({**dict.fromkeys(INSULTS, 0.9), "blor*": 0.95}))


@pytest.mark.parametrize(
    "text, toxic",
    [
        ("You are an idiot.", True), ("What a pathetic\nloser!", True), ("I will kill you", True),
        ("You are not an idiot", False), ("He said you are an idiot", False), ("He said so. You are an idiot.", True),
        ("Killing time with you", False), ("kill the old process; you win", False), ("blorben", True), ("blor", False),
        ("", False), ("idiotic", False), ("IDIOT", True),
    ],
)
def test_clauses(text, toxic):
    assert (SCORER.score(text) >= 0.5) == toxic


def test_more_clauses_score_higher():
    assert SCORER.score("idiot. moron.") > SCORER.score("idiot.") > SCORER.score("fine.")


def _marks(symbols):
    """Marks of a clause by its definition: pairs of symbols, near or in order."""
    other, insult, threat, target, negation, report = range(6)
    at = [(i, j) for j in range(len(symbols)) for i in range(j)]
    near = {(symbols[i], symbols[j]) for i, j in at if j - i <= REACH}
    after = {(symbols[i], symbols[j]) for i, j in at}
    found = {
        "aimed": {(target, insult), (insult, target)} & near,
        "threat": {(threat, target)} & near,
        "negated": {(negation, insult), (negation, threat)} & near,
        "reported": {(report, insult), (report, threat)} & after,
    }
    return {mark for mark, pairs in found.items() if pairs}


def test_composition_against_brute_force():
    draw, machine = random.Random(3), grammar()
    for _ in range(20_000):
        symbols = draw.choices(range(6), weights=(3, 1, 1, 1, 1, 1), k=draw.randrange(10))
        state, marks = machine.start, set()
        for symbol in symbols:
            state, made = machine.step(state, symbol)
            marks.update(made)
        assert marks == _marks(symbols), symbols


def test_a_clause_scores_by_its_whole_path():
    """An insult alone lies below one aimed at somebody, and each further mark tells."""
    score = SCORER.score
    assert score("said not you idiot") < score("said idiot") < score("not you idiot") < score("idiot")
    assert score("idiot") < score("you idiot") < score("I will hurt you, idiot")
    marks, clean = SCORER.weights.marks, 0.1
    assert score("you idiot") == pytest.approx(1 - clean * (1 - marks["aimed"]))
    assert score("she said you idiot") == pytest.approx((1 - clean * (1 - marks["aimed"])) * marks["reported"])
    assert score("idiot") == pytest.approx(0.9 * marks["bare"])


def test_paths_are_learned(spark):
    """Labels that call aimed insults toxic and bare ones clean turn the scores of the same word."""
    words = "idiot moron jerk clown".split()
    rows = [(f"text {k} you {w}", 1) for k in range(40) for w in words]
    rows += [(f"text {k} about what {w} can mean {m}", 0) for k in range(12) for w in words for m in ("", "today")]
    rows += [(f"plain text {k}", 0) for k in range(400)]
    scorer = Scorer(fit_weights(spark.createDataFrame(rows, "text string, toxic int")))
    for w in words:
        assert scorer.score(f"you {w}") > 0.9 and scorer.score(f"that {w}") < 0.5


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "you idiot"), (3, "you idiot"), (3, "you idiot"), (4, "fine " * 50_000 + "idiot")]
    got = score_toxicity(documents(spark, rows), SCORER.weights)
    assert got.columns == ["doc_id", "text", "score", "predicted", "clauses"]
    assert sorted((r.doc_id, r.predicted) for r in got.where("doc_id is not null").collect()) == [(1, 0), (2, 0), (3, 1), (3, 1), (4, 1)]
    assert got.where("doc_id is null").first().predicted == 1
    assert score_toxicity(documents(spark, rows).where("false"), SCORER.weights).count() == 0


def test_without_labels_the_known_words_stand(spark):
    weights = fit_weights(spark.createDataFrame([(None, 1), ("a", None)], "text string, toxic int"))
    assert weights.terms == dict.fromkeys(INSULTS, 0.8) and weights.marks["negated"] == pytest.approx(0.2)


def test_learns_words_and_stems_and_what_negation_means(spark):
    rows = [(f"common words here {k} vexu{k} not vexu{k}a", 1) for k in range(60)] + [(f"common words here {k}", 0) for k in range(300)]
    weights = fit_weights(spark.createDataFrame(rows, "text string, toxic int"))
    assert weights.terms["vexu*"] > 0.9 and "common" not in weights.terms
    assert weights.marks["negated"] > 0.5
    assert Scorer(weights).score("vexuzz") > 0.5 > Scorer(weights).score("common vex")


def test_learns_until_no_term_passes(spark):
    """140 insults without a stem of their own, and two words of one stem that clean texts hold too."""
    names = [f"q{a}{b}x" for a in "abcdefghijklmn" for b in "opqrstuvwz"]
    rows = [(f"text {k} {w}", 1) for w in [*names, "abcdef", "abcdxyz"] for k in range(8)]
    rows += [(f"text {k % 8} abcdaa{k % 3} other{k}", 0) for k in range(2000)]
    terms = fit_weights(spark.createDataFrame(rows, "text string, toxic int")).terms
    assert {*names, "abcdef", "abcdxyz"} <= set(terms) and "abcd*" not in terms


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op3_toxicity(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic is not null").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    right = [got[r.doc_id].predicted == r.toxic for r in labels if got[r.doc_id].held_out]
    assert sum(right) >= 0.95 * len(right)


def test_learning_leaves_held_out_rows(spark):
    docs = documents(spark, [(k, f"t{k}") for k in range(40)])
    labels = spark.createDataFrame([(k, 1, "z") for k in range(40)] + [(None, 1, "z"), (1, None, "z")], "doc_id long, toxic int, text string")
    texts = {r.text for r in labelled_texts(docs, labels).collect()}
    assert texts == {f"t{k}" for k in range(40) if zlib.crc32(str(k).encode()) % 5}
