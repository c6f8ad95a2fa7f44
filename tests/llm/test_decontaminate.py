import random

import duckdb
import pytest

from helpers import ALNUM, documents, lowered
from wardspan.llm import decontaminate as module
from wardspan.llm.queries import op5_decontaminate
from wardspan.llm.sql import OP5


def brute(text, items, width=10):
    words = ALNUM.findall(lowered(text))
    hit, names = set(), set()
    for item, passage in items:
        own = ALNUM.findall(lowered(passage))
        size = min(width, len(own))
        if not size:
            continue
        windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                names.add(item)
    return len(words), sorted(hit), sorted(str(n) for n in names - {None}), None in names


def case(rng):
    words = [f"w{k}" for k in range(6)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 9, 10, 14])))) for k in range(12)]
    items += [(None, "w1 w2 w3 w1 w2 w3"), (None, "é Ünter w1"), (8, items[8][1]), (50, None), (51, "!?"), (3, "w1 w2 w3 w4 w5 w0 w1 w2 w3 w4 w5"), (10, "é Ünter w1")]
    rows = [(k, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.choice([0, 5, 12, 60])))) for k in range(60)]
    rows += [(100, None), (None, items[8][1]), (101, items[5][1].upper()), (102, "x é ünter! W1"), (102, "x é ünter! W1")]
    return rows, items


@pytest.mark.parametrize("block", [8 << 20, 40])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    rows, items = case(random.Random(2))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, id string")
    got = module.decontaminate(documents(spark, rows), bench).collect()
    seen = [(r.doc_id, r.n_words, sorted({w for p in r.places for w in range(p.start, p.end + 1)}), r["items"], r.unnamed) for r in got]
    assert sorted(seen, key=str) == sorted([(i, *brute(t, items)) for i, t in rows], key=str)
    for r in got:
        words = ALNUM.findall(lowered(r.text))
        pieces = [ALNUM.findall(lowered(r.text[s.start : s.end])) for s in r.spans]
        assert pieces == [words[p.start : p.end + 1] for p in r.places]
    kept = module.without_contaminated(documents(spark, rows), bench)
    assert kept.columns == documents(spark, rows).columns
    want = [(i, t) for i, t in rows if not brute(t, items)[1]]
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=str) == sorted(want, key=str)


def test_empty_tables_and_a_long_text(spark):
    rows = [(1, "a b c " * 100_000 + "d e f")]
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "c d e f")], "item_id long, text string")
    docs = documents(spark, rows)
    assert module.decontaminate(docs, none).first()["items"] == []
    assert module.decontaminate(docs.where("false"), bench).count() == 0
    assert [tuple(p) for p in module.decontaminate(docs, bench).first().places] == [(299_999, 300_002)]
    assert module.without_contaminated(docs, none).count() == 1


def test_query_counts_an_item_without_an_id(spark, tmp_path):
    """As the SQL does: its words are hit, it is one of the items, and it has no name among them."""
    documents(spark, [(1, "x one two. Three"), (2, "four five"), (3, "one two three four five"), (4, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(None, "one two three"), (None, "one two three"), (7, "four five")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(OP5)
    names = [d[0] for d in want.description]
    got = op5_decontaminate(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    assert {r.doc_id: (r.n_hit, r.n_items) for r in got} == {1: (3, 1), 2: (2, 1), 3: (5, 2), 4: (0, 0)}


def test_texts_meet_python_once_and_equal_items_are_cut_up_once(spark):
    """One pass of Python over the texts gives hits and offsets; codes are short and tell words apart."""
    words = [f"w{k}".encode() for k in range(3000)]
    codes = module._codes(dict.fromkeys(words))
    assert len(set(codes.values())) == 3000 and {len(c) for c in codes.values()} == {2}
    assert not set("".join(codes.values())) & {module._OTHER}
    text = " ".join(f"w{k}" for k in range(300))
    windows = module._Windows([(str(k), text) for k in range(50)] + [(None, text)], 10)
    assert {len(texts) for _, (_, texts) in windows.matches(module._words(text))} == {1}
    assert windows.items == [{None, *map(str, range(50))}]
    bench = spark.createDataFrame([(k, text) for k in range(12)], "item_id long, text string")
    found = module.decontaminate(documents(spark, [(1, f"x {text} y"), (2, "w1 w0")]), bench)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = {r.doc_id: r for r in found.collect()}
    assert got[1]["items"] == sorted(map(str, range(12))) and [tuple(s) for s in got[1].spans] == [(2, 2 + len(text))]
    assert got[2]["items"] == [] and got[2].spans == []


def test_a_worker_cuts_a_block_up_once_and_holds_one_block():
    class Block:
        value = [("a", "one two three")]

    first = module._kept(Block, "first", 2)
    assert module._kept(Block, "first", 2) is first
    assert module._kept(Block, "second", 2) is not first
    assert module._kept(Block, "first", 2) is not first
