"""Quality by importance resampling.

Two generative models of hashed words, word pairs and three bytes in a row, one of texts labelled good
and one of all texts, give every text the log of its chance under the first over
that under the second. Adding Gumbel noise and keeping the greatest draws texts
without replacement in proportion to that ratio.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.llm.sharding import KEY_BITS, splitters
from wardspan.llm.words import SPACES, mix, slices, text_bytes, word_numbers
from wardspan.sources.stage import Scratch, materialise

#: Texts labelled good that the target model is counted on, about, however many there are.
LABELLED_ROWS = 20_000
#: Buckets of the models: this many times the root of the words, as a power of two.
BUCKETS_A_ROOT = 16
#: Buckets of models sent whole to every task (16 MB); larger models are tables joined by bucket.
SENT_BUCKETS = 1 << 22
#: Steps in one of the weights that are summed over joined rows, so that no order changes a sum.
STEPS = 1 << 24


def _ngrams(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of words, of word pairs and of three bytes in a row, each with where every text's begin and end."""
    words, bounds = word_numbers(column, SPACES)
    data, offsets = text_bytes(column)
    data = data.astype(np.uint64)
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])
    triples = mix((data[:-2] << np.uint64(16)) + (data[1:-1] << np.uint64(8)) + data[2:] + np.uint64(1 << 32))
    for numbers, edges, last in ((words, bounds, 0), (pairs, bounds, 1), (triples, offsets, 2)):
        starts = np.minimum(edges[:-1], len(numbers))
        ends = np.maximum(starts, edges[1:] - last)  # none reaches into the next text
        yield (numbers & np.uint64(size - 1)).astype(np.int64), starts, np.minimum(ends, len(numbers))


def _held(found: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Those of the buckets that lie in a text."""
    inside = np.zeros(len(found) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    return found[np.cumsum(inside[:-1]) > 0]


def _chosen(ids: pa.Array, good: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.isin(np.asarray(ids.fill_null(-1)), good) & ids.is_valid().to_numpy(False))


def _counted(size: int, good):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in slices(batches, 1):
            chosen = _chosen(batch.column(0), good.value)
            for found, starts, ends in _ngrams(batch.column(1), size):
                raw += np.bincount(_held(found, starts, ends), minlength=size)
                for k in chosen:
                    target += np.bincount(found[starts[k] : ends[k]], minlength=size)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"]
        )

    return run


def fit_ratio(docs: DataFrame, good: np.ndarray, buckets: int) -> np.ndarray:
    """Log of target over raw chance of each bucket; docs is (id, text), good the target's ids."""
    good = docs.sparkSession.sparkContext.broadcast(np.sort(good))
    counts = docs.mapInArrow(_counted(buckets, good), "bucket long, raw long, target long")
    counts = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    at = counts["bucket"].to_numpy()
    raw[at], target[at] = counts["raw"].to_numpy(), counts["target"].to_numpy()
    if not target.sum():
        return np.zeros(buckets, np.float32)
    base = (raw + 0.1) / (raw.sum() + 0.1 * buckets)  # the target leans on the raw model where it has seen little
    return np.log((target + 50 * buckets * base / buckets) / (target.sum() + 50) / base).astype(np.float32)


def _weighed(texts: DataFrame, good: np.ndarray, buckets: int) -> DataFrame:
    """``texts`` (id, text) with log_weight by models that every task holds."""
    ratio = texts.sparkSession.sparkContext.broadcast(fit_ratio(texts, good, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            weight = np.zeros(batch.num_rows)
            for found, starts, ends in _ngrams(batch.column(1), buckets):
                sums = np.r_[0.0, np.cumsum(ratio.value[found], dtype=np.float64)]
                weight += sums[ends] - sums[starts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(weight)],
                names=["id", "text", "log_weight"],
            )

    return texts.mapInArrow(weigh, "id long, text string, log_weight double")


def _listed(size: int, good):
    """As ``_counted`` for models too large for one task: the counts of a piece of text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            chosen = _chosen(batch.column(0), good.value)
            for found, starts, ends in _ngrams(batch.column(1), size):
                seen, raw = np.unique(_held(found, starts, ends), return_counts=True)
                own = np.concatenate([found[:0], *(found[starts[k] : ends[k]] for k in chosen)])
                target = np.bincount(np.searchsorted(seen, own), minlength=len(seen))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen, pa.int64()), pa.array(raw, pa.int64()), pa.array(target, pa.int64())],
                    names=["bucket", "raw", "target"],
                )

    return run


def _entries(size: int, frequent):
    """(row, bucket, steps): for each text the weight of its frequent buckets under -1, and how often it has each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, steps = frequent.value
        for batch in slices(batches, 1):
            rows, texts = np.asarray(batch.column(0)), batch.num_rows
            weight = np.zeros(texts, np.int64)
            for found, starts, ends in _ngrams(batch.column(1), size):
                known, worth = np.zeros(len(found), bool), np.zeros(len(found), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                    known = keys[at] == found
                    worth[known] = steps[at[known]]
                sums = np.r_[0, np.cumsum(worth)]
                weight += sums[ends] - sums[starts]
                lengths = ends - starts
                before = np.cumsum(lengths) - lengths
                spots = np.arange(lengths.sum()) + np.repeat(starts - before, lengths)
                of = np.repeat(np.arange(texts), lengths)
                rest = ~known[spots]
                pairs, n = np.unique(of[rest] * size + found[spots[rest]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[pairs // size]), pa.array(pairs % size), pa.array(n, pa.int64())], names=["row", "bucket", "steps"]
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.full(texts, -1)), pa.array(weight)], names=["row", "bucket", "steps"]
            )

    return run


def joined_weights(texts: DataFrame, good: np.ndarray, size: int, sent: int, scratch: Scratch) -> DataFrame:
    """``texts`` (id, text) with log_weight by models of any number of buckets.

    Buckets that hold at least one in ``sent`` / 4 of all n-grams, so no more
    than that many, are sent to the tasks and summed there. Of every other
    bucket a text sends one row with its count, which meets the bucket's weight
    in a join that no bucket can make uneven. Sums are of whole steps.
    """
    context = texts.sparkSession.sparkContext
    counts = texts.mapInArrow(_listed(size, context.broadcast(np.sort(good))), "bucket long, raw long, target long")
    counts = scratch.write(counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")), "counts")
    raw, target = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("raw", "target")]).first()
    if not target:
        return texts.withColumn("log_weight", F.lit(0.0))
    base = (F.col("raw") + 0.1) / F.lit(raw + 0.1 * size)
    ratio = F.log((F.col("target") + 50 * base) / F.lit(target + 50.0) / base).cast("float")
    weights = counts.select("bucket", "raw", F.round(ratio.cast("double") * STEPS).cast("long").alias("weight"))
    often = F.col("raw") >= raw / max(1, sent >> 2)
    known = weights.where(often).select("bucket", "weight").orderBy("bucket").toArrow()
    frequent = context.broadcast((known["bucket"].to_numpy(), known["weight"].to_numpy()))
    numbered = scratch.write(texts.withColumn("row", F.monotonically_increasing_id()), "numbered")
    entries = numbered.select("row", "text").mapInArrow(_entries(size, frequent), "row long, bucket long, steps long")
    entries = scratch.write(entries, "entries")
    rare = entries.where("bucket >= 0").join(weights.where(~often), "bucket").select("row", (F.col("steps") * F.col("weight")).alias("steps"))
    sums = entries.where("bucket < 0").select("row", "steps").unionByName(rare).groupBy("row").agg(F.sum("steps").alias("steps"))
    return numbered.join(sums, "row").select("id", "text", (F.col("steps") / F.lit(float(STEPS))).alias("log_weight"))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = LABELLED_ROWS,
    sent: int = SENT_BUCKETS,
) -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``<text_col>``, log_weight, drawn_key, kept.

    ``log_weight`` is the log of the ratio of the two models; ``drawn_key`` adds
    Gumbel noise that depends on seed, id and text alone; ``kept`` marks the
    ``share`` of rows with the greatest keys (as a default the share of good
    labels; rows that are equal in id and text share a key and are kept or not
    together). The raw model and the draw cover all rows, the target model about
    ``rows`` labelled ones. Null and empty texts have weight 0; null
    ids are drawn like others. The buckets of the models grow with the root of
    the volume; models of up to ``sent`` buckets are sent to every task, larger
    ones joined to the texts. Without good labels all weights
    are 0; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("good"))
    known = known.where("id is not null and good in (0, 1)").groupBy("id").agg(F.max("good").alias("good"))
    known = known.where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    total, positive = known.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    share = (positive / total if total else 1.0) if share is None else share
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, rows / max(positive, 1))))
    good = known.where(part & (F.col("good") == 1)).select("id").toArrow()["id"].to_numpy()

    volume = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = 1 << ceil(log2(BUCKETS_A_ROOT * (volume / 6 + 1) ** 0.5))
    if buckets <= sent:
        weighed = _weighed(texts, good, buckets)
    else:
        weighed = materialise(joined_weights(texts, good, buckets, sent, scratch), "weighed")
    draw = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(1 << 52)).cast("double") + 0.5
    noise = -F.log(-F.log(draw / F.lit(float(1 << 52))))
    weighed = weighed.withColumn("drawn_key", F.col("log_weight") + noise)
    # The key as a whole number that keeps its order, for an exact count of what lies below a boundary.
    # Logarithms bring keys of any size, of either sign, within 1024.
    key = F.col("drawn_key")
    place = F.floor((F.signum(key) * F.log1p(F.abs(key)) + 1024) * float(1 << (KEY_BITS - 11)))
    keys = scratch.write(weighed.select(place.alias("key"), F.lit(1).alias("size")), "keys")
    cut = splitters(keys, [1 - share], 0.0)[0][0] if 0 < share < 1 else (0 if share >= 1 else 1 << KEY_BITS)
    scratch.drop()
    return weighed.select(
        F.col("id").alias(id_col), F.col("text").alias(text_col), "log_weight", "drawn_key", (place >= cut).alias("kept")
    )
