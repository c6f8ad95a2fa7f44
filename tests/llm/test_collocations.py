import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import LOWER
from wardspan.llm import collocations
from wardspan.llm.collocations import LONGEST, _bytes, _table, frequent_prefixes, mine_collocations


def brute(rows, least=100, best=2000, contained=100):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    total, counts = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, LONGEST + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        kept = []
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            if any(
                100 * f >= contained * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, f in candidates.items() if len(q) > len(p)
            ):
                continue
            n = total[lang]
            score, k = min((1000 * a * n // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def table(spark, rows):
    shape = "lang string, text string, word string, key string, n int, f int, rank int"
    return spark.createDataFrame([(*r, "w", "k", 1, 2, 3) for r in rows], shape)


def mined(df, **more):
    return sorted(tuple(r) for r in mine_collocations(df, **more).collect())


def made(seed, texts, words, langs=("en", "de", None)):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(9))
    rows = []
    for _ in range(texts):
        parts = [rng.choice([" ", "\t ", ". ", "\n", ",", "  "]) + rng.choice(words) for _ in range(rng.randrange(60))]
        rows.append((rng.choice(langs), "".join(parts) + rng.choice(["", " " + passage, " A b C d é"])))
    return rows


WORDS = ["a", "A", "b", "c", "Éa", "é", "ß", "x-y", "\x0bz", "ha"]


def test_equals_counting_everything(spark):
    rows = made(1, 150, WORDS) + [("en", None), (None, ""), ("fr", "  "), ("en", "ha " * 400)]
    got = mined(table(spark, rows).repartition(5), least=20, best=30)
    assert got == brute(rows, 20, 30) and {r[0] for r in got} == {"en", "de", "und"}
    assert mined(table(spark, rows), least=20, best=30, contained=60) == brute(rows, 20, 30, 60)


def test_repeated_rows_and_many_languages(spark):
    rows = made(2, 40, WORDS, ["en"]) * 6 + [(f"l{i}", "one two three " * 9) for i in range(30)]
    assert mined(table(spark, rows).repartition(7), least=8) == brute(rows, 8)


def test_long_words_and_texts(spark):
    rows = [("en", ("x" * 3000 + " y ") * 60 + "and so on " * 20_000), ("en", "😀 🎉 " * 200)]
    assert mined(table(spark, rows), least=50) == brute(rows, 50)


def test_empty_table_and_none_frequent(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [("en", "a b c")])) == []


def test_full_filters_change_nothing(spark, monkeypatch):
    """Filters so small that all their buckets are marked only let more through."""
    rows = made(3, 120, [f"w{i}" for i in range(40)], ["en", "de"])
    monkeypatch.setattr(collocations, "WORD_BITS", 6)
    monkeypatch.setattr(collocations, "PAIR_BITS", (16, 16))
    monkeypatch.setattr(collocations, "RANGE_ROWS", 200)
    assert mined(table(spark, rows).repartition(4), least=15) == brute(rows, 15)


def test_words_of_one_number_are_told_apart(spark, monkeypatch):
    """A seed that gives two frequent words one number is passed over."""
    real = collocations._number

    def alike(word, width, seed):
        return 7 if seed == 0 else real(word, width, seed)

    monkeypatch.setattr(collocations, "_number", alike)
    rows = made(4, 60, WORDS, ["en"])
    assert mined(table(spark, rows), least=10) == brute(rows, 10)


@pytest.mark.parametrize("width", [4, 5, 8])
def test_bytes_give_back_their_numbers(width):
    rng = np.random.default_rng(width)
    rows = rng.integers(1, 1 << 8 * width - 1, (200, LONGEST)).astype(np.uint64)
    rows[np.arange(LONGEST) >= rng.integers(2, LONGEST + 1, (200, 1))] = 0
    raw, size = _bytes(rows, width)
    keys = [row[:n].tobytes() for row, n in zip(raw, size)]
    assert (_table(b"".join(keys), size, width) == rows).all()
    assert sorted(keys) == [keys[int(i)] for i in np.lexsort(rows.T[::-1])]


def test_ranges_share_the_suffixes_of_a_frequent_pair(spark, monkeypatch):
    """Half of all suffixes begin with one pair: it is counted in several ranges, and whole."""
    spread, real = [], collocations._splitters

    def seen(*args):
        spread.append(real(*args))
        return spread[-1]

    monkeypatch.setattr(collocations, "RANGE_ROWS", 300)
    monkeypatch.setattr(collocations, "_splitters", seen)
    rng = random.Random(6)
    rows = [("en", "hot pair " + " ".join(rng.choices("abcdef", k=4)) + ". ") for _ in range(1500)] + [("zz", "hot pair " * 30)]
    assert mined(table(spark, rows).repartition(3), least=30) == brute(rows, 30)
    first, bounds = spread[0]["en"]
    leading = [key[:8] for key in bounds]
    assert max(leading.count(key) for key in leading) >= 2


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(5)
    rows = rng.integers(1, 4, (3000, LONGEST)).astype(np.uint64)
    rows[np.arange(LONGEST) >= rng.integers(2, LONGEST + 1, (3000, 1))] = 0
    n = rng.integers(1, 5, 3000)
    want = Counter()
    for row, count in zip(rows.tolist(), n.tolist()):
        for k in range(2, LONGEST + 1):
            if row[k - 1]:
                want[tuple(row[:k])] += count
    lowest, highest = min(map(tuple, rows.tolist())), max(map(tuple, rows.tolist()))
    ends = {end[:k] for end in (lowest, highest) for k in range(2, LONGEST + 1) if end[k - 1]}
    for least in (1, 40, 300, 10_000):
        got = {tuple(rows[r][:k].tolist()): c for r, k, c in frequent_prefixes(rows, n, least)}
        assert got == {p: c for p, c in want.items() if c >= least or p in ends}
    assert list(frequent_prefixes(rows[:0], n[:0], 1)) == []
