import random

import pytest

from helpers import documents
from wardspan.llm.queries import op7_quality
from wardspan.llm.quality import resample

FOLDER = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, "x") for i, q in rows], "doc_id long, quality int, text string")


def test_good_texts_stay(spark):
    rng = random.Random(1)
    good, bad = [f"g{k}" for k in range(50)], [f"b{k}" for k in range(50)]
    rows = [(k, " ".join(rng.choices(good if k % 4 else bad, k=40))) for k in range(400)]
    known = labels(spark, [(k, int(k % 4 > 0)) for k in range(200)])
    got = resample(documents(spark, rows), known, share=0.75).collect()
    assert sum(r.kept for r in got) == 300
    assert sum(r.kept and r.doc_id % 4 > 0 for r in got) >= 290
    again = resample(documents(spark, rows).repartition(7), known, share=0.75).collect()
    assert {r.doc_id for r in got if r.kept} == {r.doc_id for r in again if r.kept}


def test_exact_share_without_labels_is_an_even_draw(spark):
    rows = [(k, f"text {k}") for k in range(500)]
    got = resample(documents(spark, rows), labels(spark, [(None, 1), (3, None)]), share=0.3).collect()
    assert sum(r.kept for r in got) == 150 and {r.log_weight for r in got} == {0.0}
    assert sum(r.kept and r.doc_id < 250 for r in got) in range(50, 101)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "a " * 50_000), (4, "!?")]
    got = resample(documents(spark, rows), labels(spark, [(3, 1)]))
    assert got.columns == ["doc_id", "text", "log_weight", "drawn_key", "kept"] and got.count() == 6
    assert {r.log_weight for r in got.where("doc_id in (1, 2)").collect()} == {0.0}
    assert resample(documents(spark, rows).where("false"), labels(spark, [])).count() == 0


def test_held_out_labels(spark):
    got = {r.doc_id: r.kept for r in op7_quality(spark, FOLDER).collect()}
    known = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    share = {q: [got[r.doc_id] for r in known if r.quality == q] for q in (0, 1)}
    assert sum(share[1]) / len(share[1]) > 0.85 and sum(share[0]) / len(share[0]) < 0.35


def test_joined_models_give_the_weights_of_sent_ones(spark):
    """The table form at lowered bounds, with a word in a third of all places, a long text and odd rows."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choice(("often", *rng.choices(words, k=2))) for _ in range(rng.randrange(60)))) for k in range(300)]
    rows += [(1, None), (2, ""), (None, "w1 w2"), (7, "often " * 40_000), (7, "often " * 40_000)]
    known = labels(spark, [(k, k % 2) for k in range(300)])
    frame = documents(spark, rows)

    def run(**more):
        got = resample(frame, known, share=0.4, **more).collect()
        return sorted(((r.doc_id or -1, r.text or "", r.log_weight, r.drawn_key, r.kept) for r in got))

    want = run()
    for sent in (1024, 8, 1):
        got = run(sent=sent)
        assert [(i, t) for i, t, *_ in got] == [(i, t) for i, t, *_ in want]
        for (_, text, weight, key, kept), (_, _, weight_, key_, kept_) in zip(got, want):
            room = 1e-7 * (2 * len(text) + 10)
            assert weight == pytest.approx(weight_, abs=room) and key == pytest.approx(key_, abs=room) and kept == kept_
    assert run(sent=8) == run(sent=8)
    assert resample(frame.where("false"), known, sent=1).count() == 0
    assert {r.log_weight for r in resample(frame, labels(spark, []), sent=1).collect()} == {0.0}


def test_extreme_texts_keep_their_order(spark):
    """Texts whose weights pass a million either way don't tie."""
    rows = [(k, "good line " * (800_000 + 1000 * k)) for k in range(3)] + [(10 + k, "bad row " * (800_000 + 1000 * k)) for k in range(3)]
    rows += [(20, "good line"), (21, "bad row")]
    got = resample(documents(spark, rows), labels(spark, [(20, 1), (21, 0)]), share=0.25).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {r.doc_id for r in sorted(got, key=lambda r: -r.drawn_key)[:2]} and len(kept) == 2
