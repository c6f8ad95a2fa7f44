"""Vectors as short codes: each part of a vector by its nearest codebook entry.

Codebooks follow Lloyd's rounds over integer components. Vectors lie in blocks,
each with a tree per part whose nodes hold a box and the sum of their points;
a tree over the entries is built anew for every round. Both trees are walked
together: bounds between the boxes of a node of points and a node of entries
rule out entries none of the points can be nearest to. Where one entry is left,
all points of the node go to it, by the node's sum; where a leaf stays
uncertain, its points are compared in integers. Blocks are written once, a
round reads them and hands on sums only.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.sources.stage import Scratch, materialise

#: Points of a block and of a leaf of its trees.
BLOCK, LEAF = 4096, 32
#: Components are multiplied by this and floored.
SCALE = 1024


@dataclass(frozen=True)
class Compressed:
    """Codes per vector, and per part the entries as rows of integers."""

    codes: DataFrame
    codebooks: list[np.ndarray]


def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length of vectors, the rows whose components are all finite, and those as floored integers."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes NaN
    starts = column.offsets.to_numpy()[:-1].astype(np.int64)
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        table = values[starts[rows][:, None] + np.arange(length)]
        finite = np.isfinite(table).all(1)
        with np.errstate(over="ignore"):
            table = np.floor(table[finite] * SCALE)
        # Sums of squares of up to four components each must fit 64 bits.
        if len(table) and 4 * np.abs(table).max() * np.sqrt(length) >= 2**31:
            raise ValueError("components too large for squared distances of 64 bits")
        yield rows[finite], table.astype(np.int64)


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, table in _integers(batch.column(1)):
            offsets = pa.array(np.arange(len(rows) + 1) * table.shape[1], pa.int32())
            vectors = pa.ListArray.from_arrays(offsets, pa.array(table.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), vectors], names=["id", "vector"])


@dataclass(frozen=True)
class Tree:
    """Nodes over points: their stretch of ``order``, children (-1 in a leaf), box, and sum of points."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray


def grow(points: np.ndarray, leaf: int) -> Tree:
    """Halves at the median of the widest side until a node has ``leaf`` points or all are equal."""
    order = np.arange(len(points))
    start, end, left, right, low, high, total = [], [], [], [], [], [], []

    def add(a: int, b: int) -> int:
        inside = points[order[a:b]]
        start.append(a), end.append(b), left.append(-1), right.append(-1)
        low.append(inside.min(0)), high.append(inside.max(0)), total.append(inside.sum(0))
        return len(start) - 1

    waiting = [add(0, len(points))]
    while waiting:
        node = waiting.pop()
        a, b, width = start[node], end[node], high[node] - low[node]
        if b - a <= leaf or not width.any():
            continue
        middle = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(points[order[a:b], width.argmax()], middle, kind="introselect")]
        left[node], right[node] = add(a, a + middle), add(a + middle, b)
        waiting += [left[node], right[node]]
    return Tree(order, *(np.array(part, np.int64) for part in (start, end, left, right, low, high, total)))


def _pack(points: np.ndarray, tree: Tree) -> bytes:
    """Points in the order of their tree, and the tree, each in the smallest type that holds it."""
    out = io.BytesIO()
    kinds = {name: part.astype(np.min_scalar_type(min(part.min(initial=0), -1 - part.max(initial=0)))) for name, part in vars(tree).items()}
    small = np.min_scalar_type(min(points.min(initial=0), -1 - points.max(initial=0)))
    np.savez(out, points=points[tree.order].astype(small), **kinds)
    return out.getvalue()


def _unpack(raw: bytes) -> tuple[np.ndarray, Tree]:
    held = np.load(io.BytesIO(raw))
    parts = {name: held[name].astype(np.int64) for name in held.files}
    return parts.pop("points"), Tree(**parts)


def _blocks(parts: int, size: int):
    """Rows of blocks: the kept columns as lists, and per part its points and tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, table in _integers(batch.column(0)):
                if table.shape[1] != size and len(rows):
                    raise ValueError(f"vectors of {table.shape[1]} components among those of {size}")
                for at in range(0, len(rows), BLOCK):
                    some, points = rows[at : at + BLOCK], table[at : at + BLOCK]
                    packed = [_pack(own, grow(own, LEAF)) for own in np.split(points, parts, axis=1)]
                    kept = [column.take(pa.array(some)) for column in batch.columns[1:]]
                    whole = pa.array([0, len(some)], pa.int32())
                    lists = [pa.ListArray.from_arrays(whole, column) for column in kept]
                    yield pa.RecordBatch.from_arrays([*lists, pa.array([packed])], names=[*batch.schema.names[1:], "_parts"])

    return run


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", x, x)


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances; by floating point where no sum can pass its 53 bits."""
    most = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4 * points.shape[1] * int(most) ** 2 < 1 << 53 else np.int64
    a, b = points.astype(kind), entries.astype(kind)
    return (_square(a)[:, None] + _square(b)[None, :] - 2 * (a @ b.T)).astype(np.int64)


def _not_beaten(low: np.ndarray, high: np.ndarray, entries: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which entries may be nearest to some point of the box, ties to the lower name.

    Compared with the entry nearest to the middle of the box: at the corner that
    favours an entry most, it must be nearer than that one.
    """
    apart = _square(low + high - 2 * entries)
    best = np.lexsort((names, apart))[0]
    corner = np.where(entries > entries[best], high, low)
    lead = _square(corner - entries[best]) - _square(corner - entries)
    return (lead > 0) | ((lead == 0) & (names <= names[best]))


def assign(points: np.ndarray, tree: Tree, entries: np.ndarray, book: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of every point (in the tree's order), and per entry the count and sum of its points.

    ``book`` is a tree over the entries with leaves of one.
    """
    codes = np.zeros(len(points), np.int64)
    counts, sums = np.zeros(len(entries), np.int64), np.zeros_like(entries)
    unsure = np.zeros(len(points), bool)
    waiting = [(0, np.zeros(1, np.int64))]
    while waiting:
        node, others = waiting.pop()
        low, high = tree.low[node], tree.high[node]
        while True:
            gap = np.maximum(np.maximum(low - book.high[others], book.low[others] - high), 0)
            far = np.maximum(high - book.low[others], book.high[others] - low)
            others = others[_square(gap) <= _square(far).min()]
            # Nodes of entries are opened while they are wider than the node of points.
            width = (book.high[others] - book.low[others]).sum(1)
            leaf = tree.left[node] < 0
            wide = (book.left[others] >= 0) & (leaf | (width >= (high - low).sum()))
            if not wide.any():
                break
            opened = others[wide]
            others = np.concatenate([others[~wide], book.left[opened], book.right[opened]])
        a, b = tree.start[node], tree.end[node]
        single = book.left[others] < 0
        if single.all():
            names = _lowest_names(book, others)
            kept = _not_beaten(low, high, entries[names], names)
            others, names = others[kept], names[kept]
            if len(names) == 1:
                codes[a:b] = names[0]
                counts[names[0]] += b - a
                sums[names[0]] += tree.total[node]
                continue
        if tree.left[node] < 0:
            names = np.sort(names)
            codes[a:b] = names[_distances(points[a:b], entries[names]).argmin(1)]
            unsure[a:b] = True
        else:
            waiting += [(tree.left[node], others), (tree.right[node], others)]
    rest = np.flatnonzero(unsure)
    if len(rest):
        rest = rest[np.argsort(codes[rest], kind="stable")]
        names, starts, sizes = np.unique(codes[rest], return_index=True, return_counts=True)
        counts[names] += sizes
        sums[names] += np.add.reduceat(points[rest], starts, axis=0)
    return codes, counts, sums


def _lowest_names(book: Tree, leaves: np.ndarray) -> np.ndarray:
    """The entry of each leaf; of equal entries in one leaf, the lowest."""
    return np.array([book.order[book.start[n] : book.end[n]].min() for n in leaves], np.int64)


def _sums(codebooks: list[np.ndarray]):
    """Rows (part, entry, place, n, total) of all blocks of a task; place -1 has the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [grow(entries, 1) for entries in codebooks]
        counts = [np.zeros(len(entries), np.int64) for entries in codebooks]
        sums = [np.zeros_like(entries) for entries in codebooks]
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                for k, raw in enumerate(packed):
                    _, n, total = assign(*_unpack(raw), codebooks[k], books[k])
                    counts[k] += n
                    sums[k] += total
        for k, entries in enumerate(codebooks):
            used = np.flatnonzero(counts[k])
            table = np.concatenate([counts[k][used][:, None], sums[k][used]], axis=1)
            entry, place = np.repeat(used, table.shape[1]), np.tile(np.arange(table.shape[1]) - 1, len(used))
            columns = [np.full(len(entry), k), entry, place, table.ravel()]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "entry", "place", "total"])

    return run


def _codes(codebooks: list[np.ndarray]):
    """The kept columns of every vector, its code and its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [grow(entries, 1) for entries in codebooks]
        for batch in batches:
            for row in range(len(batch)):
                kept = [column.slice(row, 1).flatten() for column in batch.columns[:-1]]
                found, error = [], np.zeros(len(kept[0]), np.int64)
                for k, raw in enumerate(batch.column(len(kept))[row].as_py()):
                    points, tree = _unpack(raw)
                    codes, _, _ = assign(points, tree, codebooks[k], books[k])
                    own = np.zeros(len(points), np.int64)
                    own[tree.order] = codes
                    error[tree.order] += _square(points - codebooks[k][codes])
                    found.append(own)
                offsets = pa.array(np.arange(len(error) + 1) * len(found), pa.int32())
                code = pa.ListArray.from_arrays(offsets, pa.array(np.stack(found, 1).ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([*kept, code, pa.array(error)], names=[*batch.schema.names[:-1], "code", "error"])

    return run


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: Sequence[str] = (),
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
) -> Compressed:
    """``codes``: <id_col>, the ``keep`` columns, code (an entry per part), error; and the codebooks.

    A component x counts as floor(1024 x). A vector is cut into ``parts`` equal
    parts, each with a codebook that starts as that part of the ``entries``
    vectors of the smallest ids (null ids last, equal ids by components; fewer
    vectors, fewer entries). A round assigns every part to its nearest entry, by
    squared distance and then the lower index, and moves each entry to the floor
    of the mean of its parts; unused ones stay. The codes are of a last
    assignment; error is the sum of its squared distances, exact.

    Null and empty vectors and those with null or non-finite components are
    left out; all others must have one length, divisible by ``parts``, and
    components whose squared distances fit 64 bits, or the call fails. Repeated
    rows and ids count each time. An empty table gives no codes and no entries.
    """
    scratch = Scratch(vectors.sparkSession)
    vector = F.col(f"`{vector_col}`").cast("array<double>").alias("_vector")
    rows = vectors.select(vector, F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in keep])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields[1:]}
    first = rows.select(F.col(f"`{id_col}`").alias("id"), "_vector")
    first = first.mapInArrow(_first, f"id {kinds[id_col]}, vector array<bigint>")
    heads = first.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    sizes = {len(row["vector"]) for row in heads}
    if len(sizes) > 1 or any(size % parts for size in sizes):
        raise ValueError(f"vectors of {sorted(sizes)} components can't be cut into {parts} equal parts")
    size = sizes.pop() if sizes else 0
    codebooks = []
    if size:
        table = np.array([row["vector"] for row in heads], np.int64)
        codebooks = [np.ascontiguousarray(part) for part in np.split(table, parts, axis=1)]

    shape = ", ".join(f"`{name}` array<{kind}>" for name, kind in kinds.items())
    blocks = scratch.write(rows.mapInArrow(_blocks(parts, size), f"{shape}, _parts array<binary>"), "blocks")
    for _ in range(rounds if size else 0):
        sums = blocks.select("_parts").mapInArrow(_sums(codebooks), "part int, entry int, place int, total long")
        moved = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
        found: dict[tuple[int, int], dict[int, int]] = {}
        for part, entry, place, total in moved.collect():  # a number for each of all entries' components
            found.setdefault((part, entry), {})[place] = total
        codebooks = [entries_.copy() for entries_ in codebooks]
        for (part, entry), totals in found.items():
            codebooks[part][entry] = [totals[i] // totals[-1] for i in range(size // parts)]
    shape = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    codes = blocks.mapInArrow(_codes(codebooks), f"{shape}, code array<int>, error long")
    codes = materialise(codes, "vector-codes")
    scratch.drop()
    return Compressed(codes, codebooks)
