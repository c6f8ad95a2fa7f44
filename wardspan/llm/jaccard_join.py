"""Exact Jaccard join of texts on word n-grams, as classes of linked texts.

Distance is 1 - Jaccard, a metric. Unrelated texts are all at distance 1 of
each other and of any pivot, so no pivot separates them; the space is first cut
where texts share content at all, and pivots work inside:

1. Texts with equal shingle sets become one point (the least id stands for it).
2. Every point lies in the regions of the first ``n - ceil(s n) + 1`` shingles
   of its set in one global order, frequent shingles last: two sets that reach
   similarity s share one of these (the bound on the overlap decides this, so
   it is exact whatever the order). Frequent shingles are found by counting in
   every task over all texts; they only move back in the order.
3. Each region takes its least point as pivot and compares all points with it.
   Windows rule a pair out before texts are read, each a proof: the sizes, the
   positions of the shared shingle, and the coordinates. A coordinate is how
   many of a point's shingles fall in one of 128 cells of the hash range; the
   coordinates of two points differ by no more in total than the sets do (a
   triangle inequality over 128 synthetic pivots). The rest is compared whole.
4. Points within the radius of the pivot join its class. A region whose points
   are all in one class is finished. In any other, the points outside its
   largest class are the next pivots, compared with all points, those on the
   boundary included, that the triangle inequality over the first pivot and the
   coordinates do not separate. A region with more such points than a round takes
   goes on in the next, until no untried pair of two classes is left.

A region is read as a sorted stream with only its pivots in memory. A group of
n near copies costs about n comparisons, as all regions agree on the pivot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.llm.components import components
from wardspan.llm.words import shingle_sets
from wardspan.sources.stage import Scratch, materialise

#: Cells of the hash range as coordinates in the regions; a set of over 512 shingles has finer ones besides,
#: about one for four shingles and 4096 at most.
CELLS = 128
#: A shingle of so many texts of a task is reported, one of so many of all texts is frequent.
TASK_TEXTS, ALL_TEXTS = 4, 32
#: Texts hashed at a time.
SLICE = 256
#: So many shingles at most are treated as frequent (8 MB); the rest keep their place in the order.
FREQUENT = 1 << 20
#: Counters a task keeps, and pivots of a region in the second round; eight times as many in each later one.
COUNTERS, PIVOTS = 1 << 18, 256
#: Bits of the filter that keeps texts without a pair from being hashed and sent again.
MARKS = 1 << 24
#: Pairs a task remembers to have told.
KEPT_PAIRS = 1 << 19


def _overlap(n, m, percent):
    """Least intersection with which sets of n and m reach the similarity."""
    return -((-percent * (n + m)) // (100 + percent))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows a few at a time, which bounds what hashing holds."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _profiles(width: int):
    """Per text size and fingerprint of its set; per task its frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting, held, texts = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0, 0

        def merged():
            everything = np.concatenate([keys, *waiting])
            weight = np.concatenate([counts, np.ones(len(everything) - len(keys), np.int64)])
            order = np.argsort(everything, kind="stable")
            everything, weight = everything[order], weight[order]
            first = np.flatnonzero(np.r_[True, everything[1:] != everything[:-1]]) if len(order) else order
            total = np.add.reduceat(weight, first) if len(first) else weight
            keep = total > 1
            new, total = everything[first][keep], total[keep]
            if len(new) > COUNTERS:
                best = np.sort(np.argpartition(total, -COUNTERS)[-COUNTERS:])
                new, total = new[best], total[best]
            return new, total

        for batch in _slices(batches):
            sets = shingle_sets(batch.column(1), width)
            prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            texts += len(sets)
            waiting += sets
            held += sum(map(len, sets))
            if held > 2_000_000:
                (keys, counts), waiting, held = merged(), [], 0
            none = pa.nulls(len(sets), pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(prints, pa.binary()), none, none],
                names=["id", "n", "print", "shingle", "texts"],
            )
        keys, counts = merged()
        often = counts >= max(TASK_TEXTS, texts // 2000)
        size = int(often.sum())
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(size, pa.int64()),
                pa.nulls(size, pa.int64()),
                pa.nulls(size, pa.binary()),
                pa.array(keys[often].view(np.int64)),
                pa.array(counts[often]),
            ],
            names=["id", "n", "print", "shingle", "texts"],
        )

    return run


def _prefixes(width: int, percent: int, frequent):
    """Per text its first shingles in the global order and its coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for batch in _slices(batches):
            heads, cells, coarse, sizes, prints = [], [], [], [], []
            for s in shingle_sets(batch.column(1), width):
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    late = often[at] == s
                    ordered = np.concatenate([s[~late], s[late]])
                else:
                    ordered = s
                heads.append(ordered[: len(s) + (-percent * len(s)) // 100 + 1].view(np.int64))
                bits = min(12, max(CELLS.bit_length() - 1, (len(s) // 4).bit_length()))
                count = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
                cells.append(np.minimum(count, 255).astype(np.uint8).tobytes())
                coarse.append(np.minimum(count.reshape(CELLS, -1).sum(1), 255).astype(np.uint8).tobytes())
                sizes.append(len(s))
            bounds = np.cumsum([0, *map(len, heads)])
            values = np.concatenate(heads) if heads else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values)),
                    pa.array(cells, pa.binary()),
                    pa.array(coarse, pa.binary()),
                ],
                names=["id", "n", "print", "head", "cells", "coarse"],
            )

    return run


def _first_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shingle and id: those of regions of two and more, with the pivot's fields.

    ``more`` is false where the region is known to have no third row.
    """
    held, told = None, False  # the pivot of the last region, and whether its row went out
    names = ["shingle", "id", "n", "at"]
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.asarray(batch.column(i)) for i in range(4)]
        if held is not None:
            rows = [np.concatenate([[h], r]) for h, r in zip(held, rows)]
        key = rows[0]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[first, len(key)])
        out = np.repeat(size > 1, size)
        if held is not None and told:
            out[0] = False
        pivot = np.repeat(first, size)
        more = size > 2
        more[-1] = True  # it may go on in the next batch
        more[0] |= held is not None and told
        more = np.repeat(more, size)[out]
        told = bool(size[-1] > 1 or (told and held is not None and len(first) == 1))
        held = [r[first[-1]] for r in rows]
        columns = [r[out] for r in rows] + [r[pivot][out] for r in rows[1:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns] + [pa.array(more)],
            names=[*names, "pivot", "pivot_n", "pivot_at", "more"],
        )


class _Pivots:
    """The pivots of one region so far, and which of them a point must be compared with."""

    def __init__(self, percent: int, room: int):
        self.percent, self.room, self.count = percent, room, 0
        self.whole = np.zeros((4, 64), np.int64)  # id, size, place of the shingle, class
        self.far = np.zeros(64)
        self.cells = np.zeros((64, CELLS), np.int16)

    def add(self, row: tuple, far: float, cells: np.ndarray) -> bool:
        if self.count == self.room:
            return False
        if self.count == len(self.far):
            self.whole = np.concatenate([self.whole, self.whole], axis=1)
            self.far, self.cells = np.tile(self.far, 2), np.tile(self.cells, (2, 1))
        self.whole[:, self.count], self.far[self.count], self.cells[self.count] = row, far, cells
        self.count += 1
        return True

    def near(self, row: tuple, far: float, cells: np.ndarray) -> np.ndarray:
        """Ids of pivots of other classes that no window rules out."""
        _, n, at, label = row
        ids, sizes, places, labels = self.whole[:, : self.count]
        overlap = _overlap(sizes, n, self.percent)
        fits = (labels != label) & (100 * np.minimum(sizes, n) >= self.percent * np.maximum(sizes, n))
        fits &= np.minimum(sizes - places, n - at) >= overlap
        # The distances to the region's first pivot, NaN where they weren't worked out.
        fits &= ~(np.abs(self.far[: self.count] - far) > 1 - self.percent / 100 + 1e-9)
        left = np.flatnonzero(fits)
        apart = np.abs(self.cells[left] - cells).sum(1, dtype=np.int64)
        return ids[left[apart <= sizes[left] + n - 2 * overlap[left]]]


def _more_pivots(pivots: int, percent: int):
    """Rows sorted by shingle, late and id: untried pairs, and the points of regions that aren't finished.

    The late rows of a region are those of its largest class; the others are
    its pivots. Once all of them have been compared with all rows, what is left
    is one class, and the region is finished. A pair of near texts shares many
    regions; a task tells it once as far as it remembers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, chosen, full = None, None, False
        told: set[tuple[int, int]] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, left = [], [], []
            shingles, late = batch.column(0).to_pylist(), batch.column(7).to_pylist()
            rows = np.stack([np.asarray(batch.column(i)) for i in (1, 2, 3, 4)], axis=1)
            far = batch.column(5).to_numpy(zero_copy_only=False).astype(float)
            cells = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)
            for k, shingle in enumerate(shingles):
                if shingle != region:
                    region, chosen, full = shingle, _Pivots(percent, pivots), False
                if chosen.count:
                    own = int(rows[k, 0])
                    pairs = [(x, own) for x in chosen.near(rows[k], far[k], cells[k]).tolist()]
                    pairs = [pair for pair in pairs if pair not in told]
                    if len(told) > KEPT_PAIRS:
                        told.clear()
                    told.update(pairs)
                    a += [x for x, _ in pairs]
                    b += [own] * len(pairs)
                if not late[k] and not chosen.add(rows[k], far[k], cells[k]):
                    full = True
                    left.append(k)
                elif late[k] and full:
                    left.append(k)
            picks = pa.array([None] * len(a) + left, pa.int64())
            gap = [None] * len(left)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a + gap, pa.int64()), pa.array(b + gap, pa.int64())]
                + [batch.column(i).take(picks) for i in (0, 1, 2, 3, 5)],
                names=["a", "b", "shingle", "id", "n", "at", "far"],
            )

    return run


def _near(percent: int):
    """Pairs whose coordinates don't rule the similarity out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = []
            for n, x, m, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                x, y = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
                shared = min(len(x), len(y))  # the finer one is added up
                apart = np.abs(x.reshape(shared, -1).sum(1) - y.reshape(shared, -1).sum(1)).sum()
                keep.append(bool(apart <= n + m - 2 * _overlap(n, m, percent)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"]
            )

    return run


def _sets(width: int, wanted):
    """Sets of the texts whose place is marked in the bits ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = wanted.value
        for batch in _slices(batches):
            place = np.asarray(batch.column(2))
            batch = batch.filter(pa.array((marked[place >> 3] >> (place & 7) & 1).astype(bool)))
            sets = pa.array([s.tobytes() for s in shingle_sets(batch.column(1), width)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["id", "points"])

    return run


def _place(id_):
    return F.pmod(F.xxhash64(id_), F.lit(MARKS))


def _marks(ids: DataFrame) -> np.ndarray:
    """One bit per place of the hash range, set where an id falls: 2 MB for any number of ids."""
    bits = np.zeros(MARKS // 8, np.uint8)
    place = _place(F.col("id")) + 1  # bitmaps count from 1: bucket 1 holds 1 to 32768
    maps = ids.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)))
    for k, part in maps.collect():
        at = (k - 1) * len(part)
        bits[at : at + len(part)] |= np.frombuffer(bytes(part), np.uint8)
    return bits


def _compared(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, links = [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                total = len(x) + len(y) - common
                far.append(1 - common / total)
                links.append(100 * common >= percent * total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(far, pa.float64()), pa.array(links, pa.bool_())],
                names=["a", "b", "far", "linked"],
            )

    return run


def _windowed(pairs: DataFrame, cells: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The distinct pairs (a, b) that the coordinates leave."""
    left = cells.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("cells").alias("ca"))
    right = cells.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("cb"))
    pairs = pairs.distinct().join(left, "a").join(right, "b").select("a", "b", "na", "ca", "nb", "cb")
    return scratch.write(pairs.mapInArrow(_near(percent), "a long, b long").distinct(), "near")


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b, far, linked) of the distinct pairs (a, b), from their whole sets."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = texts.sparkSession.sparkContext.broadcast(_marks(ids))
    placed = texts.select("id", "text", _place(F.col("id")).alias("place"))
    sets = placed.mapInArrow(_sets(width, wanted), "id long, points binary").join(ids, "id", "left_semi").distinct()
    sets = scratch.write(sets, "sets")
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("points").alias("x")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("points").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    compared = both.mapInArrow(_compared(percent), "a long, b long, far double, linked boolean")
    return scratch.write(compared, "compared")


def _frequent(profiles: DataFrame) -> np.ndarray:
    """Sorted numbers of the frequent shingles, FREQUENT at most; they only steer the order."""
    found = (
        profiles.where("shingle is not null")
        .groupBy("shingle")
        .agg(F.sum("texts").alias("texts"))
        .where(F.col("texts") >= ALL_TEXTS)
        .orderBy(F.desc("texts"), "shingle")
        .limit(FREQUENT)
        .select("shingle")
        .toArrow()
    )
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, n_shingles, component_id.

    Words are runs of non-white-space, A-Z lower-cased; a text of fewer than
    ``width`` words is one shingle, and a null, empty or blank text has none and
    links with nothing. Two rows link when 100 * intersection >= percent * union;
    component_id is the least id reachable by links, its own included. Rows with
    the same id are one node. A row with a null id can't be linked to; it comes
    back with its size and a null component. Other columns are ignored; an empty
    table gives an empty result. Whole texts, all rows, no pair is lost.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    named = texts.where("id is not null")
    profiles = texts.mapInArrow(_profiles(width), "id long, n long, print binary, shingle long, texts long")
    profiles = scratch.write(profiles, "profiles")
    own = profiles.where("n is not null").select("id", "n", "print")
    frequent = spark.sparkContext.broadcast(_frequent(profiles))

    points = own.where("id is not null and n > 0")
    least = scratch.write(points.groupBy("print").agg(F.min("id").alias("rep")), "least")
    heads = named.mapInArrow(
        _prefixes(width, percent, frequent), "id long, n long, print binary, head array<long>, cells binary, coarse binary"
    )
    standing = least.select(F.col("rep").alias("id"), "print")
    heads = heads.where("n > 0").dropDuplicates(["id", "print"]).join(standing, ["id", "print"], "left_semi")
    heads = scratch.write(heads, "heads")

    rows = heads.select("id", "n", F.posexplode("head").alias("at", "shingle"))
    rows = rows.select("shingle", "id", "n", F.col("at").cast("long").alias("at"))
    regions = rows.repartition("shingle").sortWithinPartitions("shingle", "id").mapInArrow(
        _first_pivots, "shingle long, id long, n long, at long, pivot long, pivot_n long, pivot_at long, more boolean"
    )
    regions = scratch.write(regions.where("id <> pivot"), "regions")
    pairs = regions.where(
        f"100 * least(n, pivot_n) >= {percent} * greatest(n, pivot_n) and "
        f"least(n - at, pivot_n - pivot_at) >= ({percent} * (n + pivot_n) + {99 + percent}) div {100 + percent}"
    )
    cells = heads.select("id", "n", "cells")
    pairs = _windowed(pairs.select(F.col("pivot").alias("a"), F.col("id").alias("b")), cells, percent, scratch)
    tried = _verify(pairs, named, width, percent, scratch)
    links = tried.where("linked").select("a", "b")
    far = tried.groupBy(F.col("a").alias("pivot"), F.col("b").alias("id")).agg(F.min("far").alias("far"))
    left = regions.where("more").join(far, ["pivot", "id"], "left").select("shingle", "id", "n", "at", "far")
    pivots = PIVOTS
    while not left.isEmpty():
        classes = components(links, scratch).withColumnRenamed("node", "id")
        members = left.join(classes, "id", "left").withColumn("label", F.coalesce("component", "id"))
        sizes = members.groupBy("shingle", "label").agg(F.count("*").alias("size"))
        unlike = sizes.groupBy("shingle").agg(F.max_by("label", "size").alias("top"), F.count("*").alias("labels"))
        members = members.join(unlike.where("labels > 1").select("shingle", "top"), "shingle")
        members = members.join(heads.select("id", "coarse"), "id").withColumn("late", F.col("label") == F.col("top"))
        members = members.select("shingle", "id", "n", "at", "label", "far", "coarse", "late")
        step = members.repartition("shingle").sortWithinPartitions("shingle", "late", "id").mapInArrow(
            _more_pivots(pivots, percent),
            "a long, b long, shingle long, id long, n long, at long, far double",
        )
        step = scratch.write(step, "round")
        untried = _windowed(step.where("a is not null").select("a", "b"), cells, percent, scratch)
        found = _verify(untried, named, width, percent, scratch)
        links = links.unionByName(found.where("linked").select("a", "b"))
        left = step.where("shingle is not null").select("shingle", "id", "n", "at", "far")
        pivots *= 8
    copies = points.join(least, "print").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    classes = components(links.unionByName(copies), scratch).withColumnRenamed("node", "id")
    result = own.select("id", "n").join(classes, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
    result = materialise(result, "jaccard-classes")
    scratch.drop()
    return result
