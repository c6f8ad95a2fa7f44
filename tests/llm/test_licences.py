import time

import pytest

from helpers import ALNUM, documents, lowered
from wardspan.llm.licences import BASE, _phrases, scan_licences


def brute(text):
    words = ALNUM.findall(lowered(text))
    found = set()
    for label, template, key, place, base in _phrases():
        for i in range(len(words) - len(key) + 1):
            if words[i : i + len(key)] == key:
                at = i - place
                stands = sum(0 <= at + k < len(words) and words[at + k] == w for k, w in enumerate(template))
                found.add((at, label, base, round(stands / len(template), 9)))
    return len(words), sorted(found)


TEXTS = [
    None, "", "...", "All rights reserved. ALL RIGHTS\nreserved!", "cc by", "cc-by cc by-nc 4.0", "by cc", "ccby",
    "This work is licensed under the GNU General Public License, version 3.", "general public", "general public license",
    "Released under the MIT License.", "mit license", "released under the mit licensee", "Licensed under CC BY-NC 4.0.",
    "license license general public license public license", "é cc by ü", "word " * 40_000 + "all rights reserved",
    "licensed under the apache license, version 2.0 cc by " * 300,
]


def test_equals_scan_of_all_words(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "cc by"), (3, TEXTS[3]), (3, TEXTS[3])]
    got = scan_licences(documents(spark, rows))
    assert got.columns == ["doc_id", "text", "n_words", "places"]
    seen = [
        (r.doc_id, r.n_words, sorted((p.start, p.label, p.base, round(p.share, 9)) for p in r.places)) for r in got.collect()
    ]
    assert sorted(seen, key=str) == sorted([(i, *brute(t)) for i, t in rows], key=str)
    assert scan_licences(documents(spark, rows).where("false")).count() == 0


def test_base_labels():
    assert BASE == {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def test_no_exchange_of_texts(spark):
    plan = scan_licences(documents(spark, [(1, "cc by")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["op4_licences", "op9_sharding"])
def test_native_plans(spark, name):
    from wardspan.llm.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_time_of_a_text_of_rare_words_grows_with_its_length(spark):
    """One word of a key phrase, very often: no candidate is compared with all others."""
    rows = [(1, "license " * 100_000 + "released under the MIT license"), (2, "all rights reserved " * 20_000)]
    start = time.perf_counter()
    got = {r.doc_id: r for r in scan_licences(documents(spark, rows)).collect()}
    assert time.perf_counter() - start < 30
    assert [(p.start, p.label) for p in got[1].places] == [(100_000, "mit")]
    assert [p.start for p in got[2].places] == list(range(0, 60_000, 3))
