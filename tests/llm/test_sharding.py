import random
import zlib
from collections import Counter, defaultdict

import pytest

from helpers import documents
from wardspan.llm.sharding import histogram_shards, splitters


def check(rows, docs, shards, tolerance=0.01):
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r.doc_id, r.text, r.size, r.text_crc32) for r in rows) == Counter(
        (i, t, size(t), zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    share = sum(sums.values()) / shards
    same = max(Counter((i, t) for i, t in docs).values())  # rows equal in id and text stay together
    slack = 2 * tolerance * share + same * max(size(t) for _, t in docs)
    assert all(abs(sums[s] - share) <= slack for s in range(shards))


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_near_equal_bytes(spark, shards):
    rng = random.Random(1)
    docs = [(k, "é" * rng.randrange(400)) for k in range(3000)] + [(5000 + k, "copy " * 30) for k in range(1500)]
    docs += [(None, None), (None, None), (7, None), (8, ""), (9, "z" * 20_000)]
    got = histogram_shards(documents(spark, docs), shards)
    assert got.columns == ["doc_id", "text", "size", "text_crc32", "shard", "slot"]
    check(got.collect(), docs, shards)


def test_small_groups_stay_together_and_empty_tables(spark):
    docs = [(k, f"text {k // 3}") for k in range(6000)]
    rows = histogram_shards(documents(spark, docs), 4).collect()
    homes = defaultdict(set)
    for r in rows:
        homes[r.text].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    assert histogram_shards(documents(spark, docs).where("false")).count() == 0


def test_splitters_are_exact(spark):
    rng = random.Random(2)
    keys = [rng.randrange(1 << 60) for _ in range(500)] + [12345] * 300
    frame = spark.createDataFrame([(k, 1) for k in keys], "key long, size int")
    cuts, rows = splitters(frame, [0.25, 0.5, 0.9], 0.0)
    assert rows == 800 and cuts == sorted(cuts)
    below = [sum(k < c for k in keys) for c in cuts]
    assert below[0] in (0, 300) or abs(below[0] - 200) <= 100
    assert below[1:] == [400, 720]
