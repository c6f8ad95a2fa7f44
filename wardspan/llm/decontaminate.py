"""Benchmark passages in texts, by one Aho-Corasick automaton.

The windows of all benchmark items become the patterns of one automaton over
normalised words, each coded by a few letters; every text is scanned once, and matches are mapped back to
words and to offsets of the original text. The patterns are the only data sent
to all tasks: items go into blocks of bounded size, and beyond one block the
texts are scanned by one automaton after the other, each of which is dropped
before the next.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections import defaultdict
from collections.abc import Collection, Iterator
from itertools import chain, product, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.llm.words import NOT_ALNUM, UPPER
from wardspan.sources.stage import materialise

#: Bytes of item text in one automaton, at most (one longer item is a block of its own).
BLOCK_BYTES = 8 << 20
_TABLE = bytes.maketrans(NOT_ALNUM + UPPER.encode(), bytes(32 if not 65 <= b <= 90 else b + 32 for b in NOT_ALNUM) + UPPER.lower().encode())
#: Letters of the codes of words, all of one byte, and the letter of every word that no item has.
_LETTERS = 250
_OTHER = "\xff"
SPANS = "array<struct<start:int,end:int>>"


def _words(text: str | None) -> list[bytes]:
    return (text if isinstance(text, str) else "").encode().translate(_TABLE).split()


class _Windows:
    """All windows of some items as one automaton, over words coded by a few letters each.

    A word of the items has as many letters as tell them all apart, any other word
    one letter that no window has. Each place of a code has letters of its own, so
    a window is found at the start of a word alone. Equal texts are cut up once.
    """

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        import ahocorasick

        owners: dict[str, list[str | None]] = defaultdict(list)
        for item, text in items:
            owners[text].append(item)
        cut = [_words(text) for text in owners]
        self.codes = _codes(dict.fromkeys(chain.from_iterable(cut)))
        #: The ids of each text, None for those without one.
        self.items = [set(ids) for ids in owners.values()]
        windows: dict[str, tuple[int, list[int]]] = {}
        for number, words in enumerate(cut):
            coded = [self.codes[w] for w in words]
            size = min(width, len(words))
            for k in range(len(words) - size + 1 if size else 0):
                texts = windows.setdefault("".join(coded[k : k + size]), (size, []))[1]
                if number not in texts[-1:]:
                    texts.append(number)
        self.automaton = ahocorasick.Automaton()
        for window, value in windows.items():
            self.automaton.add_word(window, value)
        if windows:
            self.automaton.make_automaton()

    def _coded(self, words: list[bytes]) -> Iterator[str]:
        return map(self.codes.get, words, repeat(_OTHER))

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, tuple[int, list[int]]]]:
        """Place of the last letter of each occurrence of a window, with its size and texts."""
        return self.automaton.iter("".join(self._coded(words))) if words and len(self.automaton) else iter(())

    def last_words(self, words: list[bytes], letters: list[int]) -> np.ndarray:
        """The words whose last letters are these."""
        return np.searchsorted(np.cumsum([len(c) for c in self._coded(words)]) - 1, letters)


def _codes(words: Collection[bytes]) -> dict[bytes, str]:
    """A code for each of the distinct words, all of one length."""
    places = 1
    while (_LETTERS // places) ** places < len(words):
        places += 1
    alphabets = [[chr(p * (_LETTERS // places) + k) for k in range(_LETTERS // places)] for p in range(places)]
    return dict(zip(words, map("".join, product(*alphabets))))


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of true."""
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _original(text: str, first: np.ndarray, last: np.ndarray) -> list[dict]:
    """Code points of the original text from word ``first`` to word ``last``."""
    raw = text.encode()
    word = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    starts, ends = _runs(word)
    point = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # code points up to each byte
    return [
        {"start": int(point[starts[a]] - 1), "end": int(point[ends[b]])} for a, b in zip(first, last)
    ]


def _kept(items, mark: str, width: int) -> _Windows:
    """The windows of a block, which a Python worker cuts up once for all its tasks; one block at a time is held."""
    kept = sys.modules.setdefault("wardspan_windows", types.ModuleType("wardspan_windows"))
    if getattr(kept, "mark", None) != mark:
        kept.mark = kept.windows = None  # what an earlier block holds goes first
        kept.mark, kept.windows = mark, _Windows(items.value, width)
    return kept.windows


def _scanner(items, width: int, last: bool):
    """Adds what the items' windows hit to (id, text) or to what an earlier block gave; the ``last`` block adds the offsets."""
    mark = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _kept(items, mark, width)
        for batch in batches:
            sizes, places, names, unnamed, spans = [], [], [], [], []
            columns = [batch.column(k).to_pylist() for k in ((1, 3, 4, 5) if batch.num_columns > 2 else (1,))]
            for text, *earlier in zip(*columns):
                words = _words(text)
                hits = list(windows.matches(words))
                marked, known, nameless = earlier or (None, None, False)
                sizes.append(len(words))
                if not hits and not marked and not nameless:
                    for column, value in ((places, []), (names, known or []), (unnamed, False), (spans, [])):
                        column.append(value)
                    continue
                found = set(known or ()) | ({None} if nameless else set())
                found.update(*(windows.items[k] for k in {k for _, (_, texts) in hits for k in texts}))
                spots = [tuple(p.values()) for p in marked or ()]
                if hits:
                    until = windows.last_words(words, [end for end, _ in hits])
                    spots += list(zip((until - [size - 1 for _, (size, _) in hits]).tolist(), until.tolist()))
                change = np.zeros(len(words) + 1, np.int64)
                if spots:
                    low, high = np.array(spots).T
                    np.add.at(change, low, 1)
                    np.add.at(change, high + 1, -1)
                first, final = _runs(np.cumsum(change[:-1]) > 0)
                places.append([{"start": a, "end": b} for a, b in zip(first.tolist(), final.tolist())])
                spans.append(_original(text, first, final) if last else [])
                names.append(sorted(found - {None}))
                unnamed.append(None in found)
            spot = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            made = {
                "id": batch.column(0),
                "text": batch.column(1),
                "n_words": pa.array(sizes, pa.int64()),
                "places": pa.array(places, spot),
                "items": pa.array(names, pa.list_(pa.string())),
                "unnamed": pa.array(unnamed, pa.bool_()),
            }
            if last:
                made["spans"] = pa.array(spans, spot)
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return run


def _free(items, width: int):
    """Whether a text holds no window at all."""
    mark = uuid.uuid4().hex

    @F.pandas_udf("boolean")
    def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        windows = _kept(items, mark, width)
        for texts in batches:
            yield pd.Series([next(windows.matches(_words(t)), None) is None for t in texts], dtype="bool")

    return free


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[tuple[str | None, str]], bool]]:
    """The distinct items in lists of about half of BLOCK_BYTES each, one list fetched at a time, and whether it is the last."""
    size = F.octet_length("text")
    items = benchmark.where("text is not null").select(F.col("id").cast("string").alias("id"), "text").distinct()
    total = items.agg(F.sum(size)).first()[0] or 0
    count = -(-total // (BLOCK_BYTES // 2)) or 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in items.where(block == k).collect()], k == count - 1


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``<text_col>``, n_words, places, items, unnamed, spans.

    Words are letters, digits and all beyond ASCII, A-Z lower-cased. A window is
    ``width`` consecutive words of an item; an item of fewer words is one window,
    one without words or text none. ``places`` are the runs of words (first and
    last, from 0) inside any occurrence of a window, ``spans`` the same in code
    points of the text, ``items`` the ids found, as sorted distinct strings, and
    ``unnamed`` whether an item with a null id was among them. Where the items
    fill several blocks, rows are written between the scans of two of them, so
    that one block at a time is held. A null text has no words. Repeated rows are scanned
    alike; other columns are ignored; empty tables give no rows or no hits.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    items = benchmark.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{item_text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shape = f"id {kind}, text string, n_words long, places {SPANS}, items array<string>, unnamed boolean"
    held = None
    for block, last in _blocks(items):
        if held is not None:
            rows = materialise(rows, "scanned")
            held.unpersist()
        held = spark.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_scanner(held, width, last), f"{shape}, spans {SPANS}" if last else shape)
    return rows.withColumnsRenamed({"id": id_col, "text": text_col})


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of any item; a null text holds none."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{item_text_col}`").alias("text"))
    held = None
    for block, _ in _blocks(items):
        if held is not None:
            docs = materialise(docs, "scanned")
            held.unpersist()
        held = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.where(_free(held, width)(F.col(f"`{text_col}`")))
    return docs
