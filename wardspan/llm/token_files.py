"""Token ids of documents in ORC files, in the order of their document ids.

A row is a document: its id, the number of its ids, the ids themselves and
the number of ids before it in its file. ORC stores each integer column run by
run, in stripes that are read in parallel; minima and maxima of every stripe
and row group and a Bloom filter on the document id let a reader skip what a
query on ids can't need. As rows are written in ascending id order, the ranges
of stripes and files don't overlap.

Texts are encoded after they have been put in order, so the exchange carries
texts and not ids, and the sample that places the ranges reads ids alone.
"""

from __future__ import annotations

import string
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardspan.llm.words import slices
from wardspan.operators.skew import lookup

#: Bytes of text encoded at a time, or one longer text.
ROOM = 1 << 21
#: Encoded words after which a worker starts anew.
REMEMBERED = 1 << 19
#: A character between words encoded as one text, and how many they are.
MARK, JOINED = "\x01", 1000
#: Closing marks are cut only behind one of these.
ALNUM = frozenset(string.ascii_letters + string.digits)
#: ASCII marks that may close a word: all but the apostrophe, which opens endings, and the bar of special tokens.
CLOSING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~"
#: Bytes of a stripe, rows of an entry of the row index, false hits of a Bloom filter.
STRIPE_BYTES, INDEX_ROWS, FALSE_HITS = 16 << 20, 1_000, 0.01

_COLUMNS = ["doc_id", "part", "before", "n_tokens", "ids"]


def _encoder(vocabulary: str):
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    # A task has one core: a pool of threads in every worker takes memory and no less time.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    return Tokenizer.from_file(path)


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of each run of ``size``, run after run."""
    shift, total = first - (np.cumsum(size) - size), int(size.sum())
    kind = np.int32 if total + int(first.max(initial=0)) < 1 << 31 else np.int64
    return np.repeat(shift.astype(kind), size) + np.arange(total, dtype=kind)


class _Store:
    """Runs of ids by key, laid out one after the other."""

    def __init__(self):
        self.places: dict[str, int] = defaultdict(count().__next__)  # a new key gets the next place
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.values, self.filled = np.zeros(1 << 16, np.int32), 0

    def find(self, keys: list[str], learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of every key. ``learn`` gives new ones their ids: sizes, and all ids in a row."""
        found = np.fromiter(map(self.places.__getitem__, keys), np.int64, len(keys))
        fresh = np.flatnonzero(found >= len(self.first))
        if len(fresh):
            fresh = fresh[np.unique(found[fresh], return_index=True)[1]]
            size, ids = learn([keys[i] for i in fresh])
            first = self.filled + np.cumsum(size) - size
            self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])
            if self.filled + len(ids) > len(self.values):
                self.values = np.concatenate([self.values, np.zeros(max(len(ids), len(self.values)), np.int32)])
            self.values[self.filled : self.filled + len(ids)] = ids
            self.filled += len(ids)
        return found

    def ids(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of the runs at ``found``."""
        size = self.size[found]
        return size, self.values[_spread(self.first[found], size)]


class _Words:
    """Ids by word, each distinct word encoded once.

    For a vocabulary that lower-cases, drops white space and lets no token span
    it, a text's ids are those of its words one after the other: words are cut
    at spaces and line feeds, and no special token and no normalisation reaches
    across a cut. Marks after an ASCII letter or digit that close a word are a
    word of their own; no special token holds both. A-Z are lowered early where
    nothing but ASCII and no special token is concerned. Many words are encoded
    as one text, a control character between them.
    """

    def __init__(self, vocabulary: str):
        self.encoder = _encoder(vocabulary)
        mark = self.encoder.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.words, self.parts = _Store(), _Store()

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.array([self.mark is not None and MARK not in part for part in parts], bool)
        order = np.argsort(~plain, kind="stable")
        alike, odd = [parts[i] for i in order[: plain.sum()]], [parts[i] for i in order[plain.sum() :]]
        joined = [f" {MARK} ".join(alike[i : i + JOINED]) for i in range(0, len(alike), JOINED)]
        ids = [[*e.ids, self.mark] for e in self.encoder.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.array(list(chain.from_iterable(ids)), np.int32)
        size = np.diff(np.flatnonzero(ids == self.mark), prepend=-1) - 1
        ids = ids[ids != self.mark]
        if odd:
            rest = [self.encoder.encode(part, add_special_tokens=False).ids for part in odd]
            size = np.concatenate([size, [len(r) for r in rest]])
            ids = np.concatenate([ids, np.array(list(chain.from_iterable(rest)), np.int32)])
            back = np.argsort(order)
            first = (np.cumsum(size) - size)[back]
            size = size[back]
            ids = ids[_spread(first, size)]
        return size, ids

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for word in words:
            core = word.rstrip(CLOSING)
            if core[-1:] not in ALNUM:
                core = word
            parts += core.lower() if core.isascii() and "<|" not in core else core, word[len(core) :]
        size, ids = self.parts.ids(self.parts.find(parts, self._encode))
        return size[::2] + size[1::2], ids

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with ``end`` behind it, and each text's number of ids."""
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = cut.flatten().dictionary_encode()
        if len(self.parts.places) > REMEMBERED:
            self.parts = _Store()
        if len(self.words.places) > REMEMBERED * 3 // 4:  # soon put together again from their parts
            self.words = _Store()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes five times as long
        found = self.words.find(distinct, self._learn)
        size, ids = self.words.ids(found[words.indices.to_numpy()])
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(size)])[ends]
        return np.insert(ids, total, end), np.diff(total, prepend=0) + 1


class _Whole:
    """Ids of whole texts, for vocabularies whose tokens may span white space."""

    def __init__(self, vocabulary: str):
        self.encoder = _encoder(vocabulary)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        ids = [[*self.encoder.encode(text or "", add_special_tokens=False).ids, end] for text in texts.to_pylist()]
        return np.array(list(chain.from_iterable(ids)), np.int32), np.array([len(i) for i in ids], np.int64)


def _kept(vocabulary: str) -> _Words:
    """The words a Python worker has encoded so far, kept for its next tasks."""
    kept = sys.modules.setdefault("wardspan_encoded_words", types.ModuleType("wardspan_encoded_words"))
    if vocabulary not in vars(kept):
        setattr(kept, vocabulary, _Words(vocabulary))
    return getattr(kept, vocabulary)


def _writer(vocabulary: str, end: int, by_word: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(vocabulary) if by_word else _Whole(vocabulary)
        before = 0
        for batch in slices(batches, 1, ROOM):
            values, sizes = encoder.encode(batch.column(1), end)
            ends = np.cumsum(sizes)
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            columns = [pa.array(before + ends - sizes, pa.int64()), pa.array(sizes, pa.int64())]
            ids = pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns, ids], names=_COLUMNS)
            before += int(ends[-1])

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    end: int = 2,
    by_word: bool = True,
    stripe_bytes: int = STRIPE_BYTES,
    index_rows: int = INDEX_ROWS,
) -> None:
    """Write the ids of all documents to ORC files under ``path``, ascending by ``<id_col>``.

    Each document is the ids of its whole text followed by ``end``; a null or
    empty text is ``end`` alone. Documents with a null id come first. Rows that
    share an id are written one after the other in the order of their texts'
    hashes; they may lie in several files, so a repeated id never fills one
    task. Other columns are ignored, an empty table gives no rows. ``by_word``
    False encodes each text at a stretch, for vocabularies that keep white space.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    # Equal rows can change places, so where they were read may part them.
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions("doc_id", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    encoded = rows.withColumn("part", F.spark_partition_id()).mapInArrow(
        _writer(vocabulary, end, by_word), f"doc_id {kind}, part int, before long, n_tokens long, ids array<int>"
    )
    encoded.write.options(
        **{
            "compression": "snappy",
            "orc.stripe.size": stripe_bytes,
            "orc.row.index.stride": index_rows,
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": FALSE_HITS,
        }
    ).orc(path)


def read_token_files(spark: SparkSession, path: str, ids: Sequence | None = None) -> DataFrame:
    """(doc_id, part, before, n_tokens, ids) of the documents written under ``path``.

    With ``ids`` only those documents: files' stripes and row groups whose
    range or Bloom filter excludes them aren't read.
    """
    files = spark.read.orc(path)
    return files if ids is None else files.where(F.col("doc_id").isin(list(ids)))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(4)
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = ids.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        kept = [batch.column(i) for i in range(4)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], names=[*_COLUMNS[:4], "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all files. The
    totals of files come from one column; the ids are read once, by stripes,
    in any order.
    """
    files = read_token_files(spark, path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total")).orderBy("part").collect()  # one a file
    starts, at = [], 0
    for row in totals:
        starts.append((row["part"], at))
        at += row["total"]
    kind = files.schema["doc_id"].dataType.simpleString()
    rows = files.mapInArrow(_digest, f"doc_id {kind}, part int, before long, n_tokens long, ids_crc32 long")
    rows = lookup(rows, spark.createDataFrame(starts, "part int, first long"), ["part"], "inner")
    return rows.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
