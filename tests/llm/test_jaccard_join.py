import random

import numpy as np
import pyarrow as pa
import pytest

from helpers import SPACED, components, documents, lowered
from wardspan.llm import components as component_module
from wardspan.llm import jaccard_join, words
from wardspan.sources.stage import Scratch


def brute(rows, width=5, percent=80):
    sets = []
    for _, text in rows:
        found = SPACED.findall(lowered(text))
        grams = {tuple(found[k : k + width]) for k in range(len(found) - width + 1)}
        sets.append(grams if len(found) >= width else {tuple(found)} if found else set())
    links = []
    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if common and rows[x][0] is not None and rows[y][0] is not None:
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    links.append((rows[x][0], rows[y][0]))
    group = components({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(s), group.get(i)) for (i, _), s in zip(rows, sets)), key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def corpus(rng, size=120):
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [f"p{k}" for k in range(60)]
    rows, key = [], 0
    for _ in range(size):
        base = rng.choices(vocabulary, k=rng.choice([3, 7, 30, 90]))
        if rng.random() < 0.4:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 1, 1, 2, 5])):
            copy = [w if rng.random() > rng.choice([0, 0.01, 0.04]) else rng.choice(vocabulary) for w in base]
            key += 1
            rows.append((key, " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = corpus(random.Random(seed))
    assert result(jaccard_join.ngram_jaccard_join(documents(spark, rows))) == brute(rows)


def test_chain_of_near_copies_with_few_pivots(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)
    rng, base = random.Random(5), [f"w{k}" for k in range(100)]
    rows = []
    for k in range(60):
        base[rng.randrange(100)] = f"n{k}"
        rows.append((k, " ".join(base)))
    rows += [(100 + k, " ".join([*rows[7][1].split()[:60], *(f"u{k}-{j}" for j in range(40))])) for k in range(30)]
    assert result(jaccard_join.ngram_jaccard_join(documents(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, "a b c d e f"), (1, "a b c d e f"), (1, "q r s"), (2, "q R  s"), (3, None), (4, ""), (5, " \t\n"),
        (None, "a b c d e f"), (6, "A B C D E F"), (7, "é Ü ß"), (8, "É ü ß"), (9, "x " * 30_000), (10, "x " * 20),
        (None, None), (11, "y" * 2_000_000 + " z"), (12, "y" * 2_000_000 + " z"),
    ]
    assert result(jaccard_join.ngram_jaccard_join(documents(spark, rows))) == brute(rows)
    empty = jaccard_join.ngram_jaccard_join(documents(spark, rows).where("false"))
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.count() == 0


@pytest.mark.parametrize("run", [16, 1 << 20])
def test_word_numbers_are_those_of_the_words(monkeypatch, run):
    monkeypatch.setattr(words, "RUN", run)
    texts = ["A b\tc a", None, "", "é-Ü a1", " b  B ", "long" * 50 + " a", "\x0b\x0c\x1c"]
    for kind, rule in ((words.SPACES, SPACED), (words.NOT_ALNUM, __import__("helpers").ALNUM)):
        numbers, bounds = words.word_numbers(pa.array(texts)[1:], kind)
        found = [rule.findall(lowered(t)) for t in texts[1:]]
        assert np.diff(bounds).tolist() == list(map(len, found))
        flat = [w for own in found for w in own]
        assert len(set(flat)) == len(set(numbers.tolist())) == len(set(zip(flat, numbers.tolist())))


def test_structured_words_get_numbers_of_their_own():
    """Words whose letters follow parity patterns, equal under any polynomial modulo a power of two."""
    made = []
    for size in (64, 512, 1024, 2048, 4096):
        plain = "".join("ab"[bin(i).count("1") & 1] for i in range(size))
        made += [plain, plain.translate({97: 98, 98: 97}), plain[::-1] + "a", plain[32:] + plain[:32], "a" * size, "a" * (size - 1) + "b"]
    made = sorted(set(made))
    numbers, _ = words.word_numbers(pa.array([" ".join(made)]), words.SPACES)
    assert len(set(numbers.tolist())) == len(made)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + k, 401 + k) for k in range(40)]
    links += [(900, 500 + k) for k in range(200)] + [(7, 7)]
    scratch = Scratch(spark)
    found = component_module.components(spark.createDataFrame([*links, (None, 3)], "a long, b long"), scratch)
    real = [(a, b) for a, b in links if a != b]
    assert {r.node: r.component for r in found.collect()} == components({n for link in real for n in link}, real)
    scratch.drop()
