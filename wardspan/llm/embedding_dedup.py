"""Near-duplicate vectors by sorted projection passes.

Each pass draws random hyperplanes; the concatenated sides of a vector are its
key, and vectors are ordered by key over the whole table. Similar vectors agree
in the first sides of some pass, and so stand close there: each is compared in
double precision with its next neighbours, and verified pairs of all passes are
united. Equal vectors count as one point, so a large group of copies neither
fills the windows nor is compared within itself. Where links reach the far half
of a window, that stretch of the order is a run: all pairs of a run are compared,
in pieces dealt over tasks that count links instead of listing them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.llm.components import components
from wardspan.sources.stage import Scratch, materialise

#: Sides of hyperplanes in a key.
SIDES = 62
#: Rows of the sorted order compared in one task.
BLOCK = 2048
#: Passes at least, and the recall of pairs at the threshold that their number is derived from.
PASSES, RECALL = 16, 0.95
#: Least and most places of a run, and most bytes of vectors, in one of its pieces.
PIECE, PIECE_BYTES = (512, 8192), 1 << 24
#: Rows of a piece multiplied at a time.
SLICE = 512


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as raw doubles, with a digest; the rest has null."""
    for batch in batches:
        raw, prints = [], []
        for vector in batch.column(1):
            values = vector.values if vector.is_valid else None
            good = values is not None and len(values) and not values.null_count
            if good:
                x = np.asarray(values, np.float64) + 0.0  # -0.0 becomes 0.0
                good = np.isfinite(x).all() and x.any()
            raw.append(x.tobytes() if good else None)
            prints.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(raw, pa.binary()), pa.array(prints, pa.binary())], names=["id", "raw", "print"]
        )


def passes_for(points: int, least: float, window: int) -> int:
    """Passes by which a pair at cosine ``least`` meets in a window with chance RECALL.

    It meets in a pass if it agrees on the leading sides that leave a window's
    worth of the points.
    """
    agree = 1 - acos(max(-1.0, min(1.0, least))) / pi
    meet = agree ** max(0.0, log2(max(points, 1) / window))
    return PASSES if meet >= RECALL else max(PASSES, ceil(log(1 - RECALL) / log(1 - meet)))


def _keys(passes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(SIDES - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            keys = []
            for raw in batch.column(1).to_pylist():
                x = np.frombuffer(raw, np.float64)
                if len(x) not in planes:
                    rng = np.random.Generator(np.random.PCG64(seed))
                    planes[len(x)] = rng.standard_normal((passes * SIDES, len(x)))
                side = planes[len(x)] @ (x / np.abs(x).max()) > 0
                keys.append((side.reshape(passes, SIDES) * weights).sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], names=["id", "raw", "keys"]
            )

    return run


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches covered by the intervals, those that share a place as one."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    fresh = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1]])[: len(first)])
    return first[fresh], last[np.append(fresh[1:], len(first)) - 1] if len(first) else last


def _neighbours(window: int, least: float):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        raw = block["raw"].to_pylist()
        sweep, own = np.asarray(block["pass"]), np.asarray(block["own"])
        ids, size, place = np.asarray(block["id"]), np.asarray(block["bytes"]), np.asarray(block["place"])
        found_a, found_b, first, last = [], [], [], []
        for bytes_ in np.unique(size):  # vectors of other lengths are never compared
            at = np.flatnonzero(size == bytes_)
            x = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)
            x = x / np.abs(x).max(1, keepdims=True)
            norm = np.sqrt((x * x).sum(1))
            for step in range(1, min(window, len(at) - 1) + 1):
                left, right = at[:-step], at[step:]
                near = (right - left <= window) & own[left] & (sweep[left] == sweep[right])
                cosine = (x[:-step] * x[step:]).sum(1) / (norm[:-step] * norm[step:])
                near &= cosine >= least
                found_a.append(ids[left[near]])
                found_b.append(ids[right[near]])
                far = near & (right - left > window // 2)
                first.append(place[left[far]])
                last.append(place[right[far]])
        a, b = np.concatenate([*found_a, [0]])[:-1], np.concatenate([*found_b, [0]])[:-1]
        first, last = _merged(np.concatenate([*first, [0]])[:-1], np.concatenate([*last, [0]])[:-1])
        return pa.table(
            {
                "a": pa.array(np.concatenate([np.minimum(a, b), first]), pa.int64()),
                "b": pa.array(np.concatenate([np.maximum(a, b), last]), pa.int64()),
                "stretch": pa.array(np.arange(len(a) + len(first)) >= len(a)),
            }
        )

    return run


def _runs(stretches: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """(start, end, run, first, last) of the stretches in runs longer than a window.

    Stretches of neighbouring blocks that share a place are one run, named by
    its first place.
    """
    block = F.floor(F.col("start") / BLOCK)
    after = stretches.select((block - 1).alias("block"), F.col("start").alias("next"))
    touching = stretches.withColumn("block", block).join(after, "block").where("next <= end")
    joined = components(touching.select(F.col("start").alias("a"), F.col("next").alias("b")), scratch)
    named = stretches.join(joined.withColumnRenamed("node", "start"), "start", "left")
    named = scratch.write(named.select("start", "end", F.coalesce("component", "start").alias("run")), "stretches")
    runs = named.groupBy("run").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    return named.join(runs.where(F.col("last") - F.col("first") > window), "run")


def _piece_links(least: float):
    """Links between two pieces of a run, or within one, as rows (a, b, n).

    Without b: n is the number of vectors that point a links with. Without n: a
    and b are components that a link joins. With n = 0: a link of a point whose
    id is not its own. Pairs that share an earlier run are left to that one.
    """

    def run(piece: pa.Table) -> pa.Table:
        ids, size, part = (np.asarray(piece[c]) for c in ("id", "size", "part"))
        multi, component, own = (np.asarray(piece[c]) for c in ("multi", "component", "piece"))
        number, lo, hi = (piece[c][0].as_py() for c in ("run", "i", "j"))
        raw = piece["raw"].to_pylist()
        earlier = [tuple(r for r in runs if r < number) for runs in piece["runs"].to_pylist()]
        kinds = {k: n for n, k in enumerate(dict.fromkeys(earlier))}
        kind = np.array([kinds[k] for k in earlier])
        columns = {r: n for n, r in enumerate(sorted({r for k in kinds for r in k}))}
        marks = np.zeros((len(kinds), len(columns)), np.float32)
        for k, n in kinds.items():
            marks[n, [columns[r] for r in k]] = 1
        count, joins, listed = np.zeros(len(ids), np.int64), set(), set()
        for bytes_ in np.unique(part):
            x = np.zeros((len(ids), bytes_ // 8))
            at = np.flatnonzero(part == bytes_)
            x[at] = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)
            x[at] /= np.abs(x[at]).max(1, keepdims=True)
            x[at] /= np.sqrt((x[at] * x[at]).sum(1, keepdims=True))
            left, right = at[own[at] == lo], at[own[at] == hi]
            for k in np.unique(kind[left]):
                shared = marks @ marks[k] > 0
                # Points whose ids stand for several vectors are compared in every run.
                for rows, others in (
                    (left[(kind[left] == k) & ~multi[left]], right[~shared[kind[right]] | multi[right]]),
                    (left[(kind[left] == k) & multi[left]], right),
                ):
                    if not len(rows) or not len(others):
                        continue
                    y, alone = x[others].T, ~multi[others]
                    for cut in range(0, len(rows), SLICE):
                        some = rows[cut : cut + SLICE]
                        hit = (x[some] @ y >= least) & (ids[some][:, None] != ids[others])
                        counted = hit & alone & ~multi[some][:, None]
                        count[some] += counted @ size[others]
                        if lo != hi:
                            count[others] += size[some] @ counted
                        if multi[some].any() or not alone.all():
                            p, q = np.nonzero(hit & ~counted)
                            listed |= {(min(e), max(e)) for e in zip(ids[some[p]].tolist(), ids[others[q]].tolist())}
                        if (component[some] != component[others[0]]).any() or (component[others] != component[some[0]]).any():
                            p, q = np.nonzero(hit & (component[some][:, None] != component[others]))
                            ends = np.stack([component[some[p]], component[others[q]]], 1)
                            joins |= set(map(tuple, np.unique(ends, axis=0).tolist()))
        linked = np.flatnonzero(count)
        return pa.table(
            {
                "a": pa.array([*ids[linked].tolist(), *(e[0] for e in joins), *(e[0] for e in listed)], pa.int64()),
                "b": pa.array([None] * len(linked) + [e[1] for e in joins] + [e[1] for e in listed], pa.int64()),
                "n": pa.array([*count[linked].tolist(), *([None] * len(joins)), *([0] * len(listed))], pa.int64()),
            }
        )

    return run


def embedding_near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.95,
    passes: int | None = None,
    window: int = 48,
    seed: int = 17,
) -> DataFrame:
    """One row per row of ``vectors``: ``<id_col>``, n_links, component_id, kept.

    Two vectors link when their cosine in double precision is at least
    ``least`` and some pass has them within ``window`` places or in one run, a
    stretch of the order whose links reach more than half a window. ``n_links``
    counts the other vectors linked directly, equal ones included; ``passes``
    follows from the number of distinct vectors if not given;
    component_id is the least id reachable by links; ``kept`` marks that id.
    Null, empty and zero vectors, and those with null or non-finite parts, link
    with nothing, nor do vectors of different lengths with each other. A row with a
    null id comes back with no links, a null component and kept true. Rows that
    share an id are one node. Other columns are ignored; an empty table gives an
    empty result.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    read = scratch.write(rows.mapInArrow(_read, "id long, raw binary, print binary"), "vectors")
    usable = read.where("print is not null and id is not null")
    classes = usable.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    classes = scratch.write(classes, "classes")
    if passes is None:
        passes = passes_for(classes.count(), least, window)
    points = usable.dropDuplicates(["print"]).join(classes, "print").select(F.col("rep").alias("id"), "raw")

    keyed = points.mapInArrow(_keys(passes, seed), "id long, raw binary, keys array<long>")
    keyed = keyed.select(
        F.posexplode("keys").alias("pass", "key"), "id", "raw", F.octet_length("raw").alias("bytes")
    )
    order = keyed.repartitionByRange("pass", "key", "id").sortWithinPartitions("pass", "key", "id")
    order = scratch.write(order.withColumn("row", F.monotonically_increasing_id()), "order")
    part, inside = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(tuple(r) for r in order.groupBy(part.alias("part")).agg(F.max(inside) + 1).collect())  # one a task
    starts, total = {}, 0
    for number, count in counts:
        starts[number] = total
        total += count
    start = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in starts.items() for x in kv]), part) if starts else F.lit(0)
    order = order.withColumn("place", start + inside)
    block, tail = F.floor(F.col("place") / BLOCK), F.col("place") % BLOCK < window
    dealt = order.withColumn("block", F.explode(F.when(tail, F.array(block, block - 1)).otherwise(F.array(block))))
    dealt = dealt.withColumn("own", F.col("block") == block)
    found = (
        dealt.select("block", "place", "pass", "id", "raw", "bytes", "own")
        .groupBy("block")
        .applyInArrow(_neighbours(window, least), "a long, b long, stretch boolean")
    )
    found = scratch.write(found, "found")
    pairs = scratch.write(found.where("not stretch and a <> b").select("a", "b").distinct(), "pairs")
    joined = components(pairs, scratch)
    sizes = classes.groupBy("rep").agg(F.sum("size").alias("size"), (F.count("*") > 1).alias("multi"))

    stretches = found.where("stretch").select(F.col("a").alias("start"), F.col("b").alias("end"))
    counts = None
    if not stretches.isEmpty():
        runs = _runs(stretches, window, scratch)
        blocks = F.sequence(F.floor(F.col("start") / BLOCK), F.floor(F.col("end") / BLOCK))
        cover = runs.withColumn("block", F.explode(blocks))
        members = order.select("place", "id", "raw", "bytes", block.alias("block")).join(cover, "block")
        members = members.where("place between start and end").dropDuplicates(["place"])
        members = scratch.write(members.select("run", "first", "last", "place", "id", "raw", "bytes"), "members")
        sets = members.groupBy("id").agg(F.collect_set("run").alias("runs")).join(sizes.withColumnRenamed("rep", "id"), "id")
        sets = sets.join(joined.withColumnRenamed("node", "id"), "id", "left")
        sets = scratch.write(sets.withColumn("component", F.coalesce("component", "id")), "sets")

        widest = members.agg(F.max("bytes")).first()[0] or 8
        length = F.col("last") - F.col("first") + 1
        most = max(1, min(PIECE[1], PIECE_BYTES // widest))
        places = F.least(F.greatest(F.ceil(length / 8), F.lit(PIECE[0])), F.lit(most))
        pieces = members.join(sets, "id").withColumn("piece", F.floor((F.col("place") - F.col("first")) / places))
        pieces = pieces.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((length - 1) / places))))
        pieces = pieces.select(
            "run", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"), "piece", "id", "raw",
            F.col("bytes").alias("part"), "runs", "size", "multi", "component",
        )
        inside = pieces.groupBy("run", "i", "j").applyInArrow(_piece_links(least), "a long, b long, n long")
        inside = scratch.write(inside, "inside")
        counts = inside.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
        # What runs have counted is not counted again.
        alone = sets.where("not multi")
        seen = pairs.join(alone.select(F.col("id").alias("a"), F.col("runs").alias("of_a")), "a", "left")
        seen = seen.join(alone.select(F.col("id").alias("b"), F.col("runs").alias("of_b")), "b", "left")
        seen = seen.where(~F.coalesce(F.arrays_overlap("of_a", "of_b"), F.lit(False))).select("a", "b")
        pairs = scratch.write(seen.unionByName(inside.where("n = 0").select("a", "b")).distinct(), "pairs")
        further = components(inside.where("b is not null and n is null"), scratch)
        further = further.select(F.col("node").alias("component"), F.col("component").alias("least"))
        # A component of one point has no row in ``joined`` yet.
        nodes = joined.unionByName(further.select(F.col("component").alias("node"), "component")).distinct()
        joined = nodes.join(further, "component", "left").select("node", F.coalesce("least", "component").alias("component"))

    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(sizes.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("size").alias("others"))
    if counts is not None:
        degree = degree.unionByName(counts).groupBy("rep").agg(F.sum("others").alias("others"))
    joined = joined.withColumnRenamed("node", "rep")
    known = classes.join(degree, "rep", "left").join(joined, "rep", "left")
    known = scratch.write(known, "known").select(
        "print",
        (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        F.coalesce("component", "rep").alias("component"),
    )
    result = read.select("id", F.when(F.col("id").isNotNull(), F.col("print")).alias("print")).join(known, "print", "left")
    component = F.coalesce("component", "id")
    result = result.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
    result = materialise(result, "embedding-classes")
    scratch.drop()
    return result
