"""Shards of near equal bytes by histogram sort.

Rows are ordered by a key: hash of the text, then hash of the id, so equal
texts lie side by side and a large group of them can still be cut. The driver
holds one candidate range per boundary; every round counts the exact bytes in
the sub-ranges of all candidates across partitions (one partial aggregation,
a bounded number of rows back) and narrows each candidate, until a boundary is
within tolerance. Then rows go to their shard in one exchange.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardspan.sources.stage import Scratch

#: Bits of the key, of them those of the id, and those a round adds.
KEY_BITS, ID_BITS, ROUND_BITS = 60, 30, 10
#: Rows numbered by one window of a shard, about.
RUN_ROWS = 1000


def _key(id_: Column, text: Column) -> Column:
    high = F.shiftrightunsigned(F.xxhash64(text), 64 - (KEY_BITS - ID_BITS))
    low = F.shiftrightunsigned(F.xxhash64(F.lit("row"), id_), 64 - ID_BITS)
    return F.shiftleft(high, ID_BITS).bitwiseOR(low)


def splitters(keys: DataFrame, shares: list[float], tolerance: float) -> tuple[list[int], int]:
    """(boundaries, rows) of ``keys`` (key, size): below boundary s lies ``shares[s]`` of all sizes.

    Each is off by at most ``tolerance`` of the total, or is the best boundary
    there is between two keys.
    """
    found: dict[int, int] = {}
    below = {0: 0}  # bytes below each range still open; ranges are numbered by their high bits
    shift, total, rows, targets = KEY_BITS, 0, 0, {}
    while shift:
        shift -= ROUND_BITS
        part = keys
        if below.keys() != {0} or shift + ROUND_BITS < KEY_BITS:
            part = keys.where(F.shiftright("key", shift + ROUND_BITS).isin(sorted(below)))
        counted = part.groupBy(F.shiftright("key", shift).alias("range")).agg(
            F.sum("size").alias("size"), F.count("*").alias("rows")
        )
        counts = sorted(tuple(r) for r in counted.collect())  # at most 2**ROUND_BITS rows a boundary
        if not targets:
            total, rows = sum(c[1] for c in counts), sum(c[2] for c in counts)
            targets = {s: total * share for s, share in enumerate(shares)}
        edges, at = [], {}
        for number, size, _ in counts:
            parent = number >> ROUND_BITS
            low = at.get(parent, below[parent])
            edges.append((low, low + size, number))
            at[parent] = low + size
        starts, following = [e[0] for e in edges], {}
        for s in sorted(targets.keys() - found.keys()):
            if not edges:
                found[s] = 0
                continue
            low, high, number = edges[max(0, bisect_right(starts, targets[s]) - 1)]
            near = number if targets[s] - low <= high - targets[s] else number + 1
            off = min(abs(targets[s] - low), abs(high - targets[s]))
            if off <= tolerance * total or not shift:
                found[s] = near << shift
            else:
                following[number] = low
        below = following
        if len(found) == len(targets):
            break
    return [found[s] for s in sorted(found)], rows


def histogram_shards(
    docs: DataFrame,
    shards: int = 24,
    tolerance: float = 0.01,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each row's ``<id_col>``, ``<text_col>``, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 bytes of the text plus 8; a null text has none.
    Shards hold near equal bytes: each boundary is off by ``tolerance`` of a
    shard or by half a row, whichever is more; equal texts share a shard unless
    their group is larger than that. Rows equal in id and text have one key and
    stay together. ``slot`` numbers the rows of a shard from 0 without gaps. Null
    ids and texts count like any value; other columns are ignored; an empty
    table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _key(F.col(f"`{id_col}`"), text).alias("key"),
    )
    scratch = Scratch(docs.sparkSession)
    keys = scratch.write(rows.select("key", "size"), "keys")
    cuts, total = splitters(keys, [s / shards for s in range(1, shards)], tolerance / shards)
    scratch.drop()
    shard = sum((F.when(F.col("key") >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    runs = max(1, -(-total // (shards * RUN_ROWS)))
    rows = rows.withColumns({"shard": shard, "run": F.pmod(F.xxhash64("key", "id"), F.lit(runs))})

    sizes = rows.groupBy("shard", "run").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("run")) - F.col("rows")
    sizes = sizes.select("shard", "run", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "run").orderBy("key", "id")) - 1
    placed = rows.withColumn("place", place).join(sizes, ["shard", "run"])
    return placed.select(
        F.col("id").alias(id_col),
        F.col("text").alias(text_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("place") + F.col("before")).cast("long").alias("slot"),
    )
