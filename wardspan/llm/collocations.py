"""Phrases whose words stand together more often than apart would explain.

Words are counted first. Then every place of a text is a suffix of up to five
words, cut where no frequent phrase can go on. Suffixes are routed over the
whole table by their leading words: into ranges of the order of all suffixes,
so that a frequent word or pair is spread over as many tasks as it fills, equal
ones of a run of texts counted before and those of one range packed. A task
sorts pointers to its suffixes by three-way quicksort on one word after
the other: the size of an equal part is the count of its phrase, and a part
below the least count is abandoned unsorted. Only the phrases at the two ends
of a range can go on in the next one; their partial counts are added up.

Two filters of bounded size, over words and over pairs, only save work: what
they let through wrongly is counted and then left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardspan.llm.words import mix, slices
from wardspan.operators.skew import lookup
from wardspan.sources.stage import Scratch, materialise

#: Words of the longest phrase.
LONGEST = 5
#: Bytes of text handled at a time, and suffixes of a range, were all places suffixes.
ROOM, RANGE_ROWS = 1 << 23, 4_000_000
#: Powers of two of buckets: of the word filter, and least and most of the pair filter.
WORD_BITS, PAIR_BITS = 24, (20, 29)
#: Suffixes drawn for a range, and one of how many is drawn from a text.
DRAWN, THINNED = 32, 64
#: Buckets of the pair filter counted together.
CHUNK = 1 << 16

_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """Per language: places of its words, in order, in the list of its distinct words.

    Place 0 stands between pieces.
    """
    languages = batch.column(1).dictionary_encode()
    for number, language in enumerate(languages.dictionary.to_pylist()):
        texts = batch.column(0).filter(pc.equal(languages.indices, number)).to_pylist()
        whole = b"\n".join([(text or "").encode() for text in texts]).lower().translate(_TABLE)
        cut = pc.split_pattern(pa.array([b"\n " + whole.replace(b"\n", b" \n ")], pa.large_binary()), " ")
        words = cut.flatten().dictionary_encode()
        distinct, places = words.dictionary.to_pylist(), words.indices.to_numpy()
        if b"" in distinct:  # between two spaces
            places = places[places != distinct.index(b"")]
        yield language, places, distinct


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 0, ROOM):
        for language, places, distinct in _by_language(batch):
            counts = np.bincount(places, minlength=len(distinct))
            counts[0] = 0
            kept = np.flatnonzero(counts)
            words = pa.array([distinct[i] for i in kept], pa.binary()).cast(pa.string())
            columns = [pa.array([language] * len(kept), pa.string()), words, pa.array(counts[kept], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])


def _number(word: bytes, width: int, seed: int) -> int:
    """A number of ``width`` bytes, never 0."""
    return xxhash.xxh3_64_intdigest(word, seed) % ((1 << 8 * width) - 1) + 1


def _numbered(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [_number(w.encode(), width, seed).to_bytes(width, "big") for w in batch.column(1).to_pylist()]
            languages = _language_numbers(batch.column(0).to_pylist(), seed)
            numbers = np.array([int.from_bytes(r, "big") for r in raw], np.uint64)
            slot = (mix(numbers ^ languages) & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
            columns = [*batch.columns, pa.array(raw, pa.binary()), pa.array(slot)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "key", "slot"])

    return run


def _language_numbers(languages: list[str], seed: int) -> np.ndarray:
    known = {name: xxhash.xxh3_64_intdigest(name.encode(), seed ^ 1) for name in set(languages)}
    return np.array([known[name] for name in languages], np.uint64)


def _marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _word_filter(frequent: DataFrame) -> np.ndarray:
    """Bits of the buckets that hold a frequent word, gathered 64 to a row."""
    one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    rows = frequent.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(one).alias("bits")).collect()
    words = np.zeros((1 << WORD_BITS) // 64, np.int64)
    for row in rows:
        words[row["at"]] = row["bits"]
    return words.view(np.uint8)


class _Places:
    """The places of a run of words where a phrase may begin, by the filters."""

    def __init__(self, width: int, seed: int, words, pairs=None):
        self.width, self.seed, self.words, self.pairs = width, seed, words, pairs

    def numbers(self, language: str, places: np.ndarray, distinct: list[bytes]) -> tuple[np.ndarray, np.uint64]:
        """The words' numbers, 0 for those that can't be frequent and between pieces."""
        own = _language_numbers([language], self.seed)[0]
        number = np.array([0, *(_number(w, self.width, self.seed) for w in distinct[1:])], np.uint64)
        slot = (mix(number ^ own) & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
        number[1:][~_marked(self.words, slot[1:])] = 0
        return number[places], own

    def pair_slots(self, number: np.ndarray, own: np.uint64, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Where two words that may be frequent stand together, and the bucket of each such pair."""
        at = np.flatnonzero((number[:-1] != 0) & (number[1:] != 0))
        pair = mix(mix(number[at] ^ own) + number[at + 1])
        return at, (pair & np.uint64((1 << bits) - 1)).astype(np.int64)


def _chunked(slot: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Counts of buckets, by chunk, as steps and counts of two bytes each."""
    slot, counts = np.unique(slot, return_counts=True)
    chunk = slot // CHUNK
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(slot)]):
        step = np.diff(slot[start:end] - chunk[start] * CHUNK, prepend=0)
        many = np.minimum(counts[start:end], 0xFFFF)  # enough to pass any least count below
        yield int(chunk[start]), b"".join([step.astype("<u2").tobytes(), many.astype("<u2").tobytes()])


def _count_pairs(places: _Places, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, ROOM):
            found = [np.zeros(0, np.int64)]
            for language, at, distinct in _by_language(batch):
                number, own = places.numbers(language, at, distinct)
                found.append(places.pair_slots(number, own, bits)[1])
            rows = list(_chunked(np.concatenate(found)))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "counts"])

    return run


def _pair_bits(least: int):
    """Bits of the buckets with ``least`` pairs, chunk after chunk of rows sorted by it."""

    def done(chunk: int, total: np.ndarray) -> pa.RecordBatch:
        bits = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([bits])], names=["chunk", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, np.zeros(CHUNK, np.int64)
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if chunk != current:
                    if current is not None:
                        yield done(current, total)
                    current, total = chunk, np.zeros(CHUNK, np.int64)
                step, many = np.frombuffer(counts, "<u2").reshape(2, -1).astype(np.int64)
                total[np.cumsum(step)] += many
        if current is not None:
            yield done(current, total)

    return run


def _pair_filter(rows: DataFrame, places: _Places, bits: int, least: int) -> np.ndarray:
    """Bits of the buckets that may hold a frequent pair."""
    counted = rows.mapInArrow(_count_pairs(places, bits), "chunk int, counts binary")
    dealt = counted.repartition("chunk").sortWithinPartitions("chunk")
    marks = dealt.mapInArrow(_pair_bits(min(least, 0xFFFF)), "chunk int, bits binary")
    pairs = np.zeros((1 << bits) // 8, np.uint8)
    for row in marks.toLocalIterator():
        pairs[row["chunk"] * (CHUNK // 8) :][: CHUNK // 8] = np.frombuffer(row["bits"], np.uint8)
    return pairs


def _suffixes(batch: pa.RecordBatch, places: _Places, bits: int, filters) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Per language, the sorted distinct suffixes of a run of texts as rows of numbers, and how often each occurs."""
    places.words, pairs = filters.value
    for language, at, distinct in _by_language(batch):
        number, own = places.numbers(language, at, distinct)
        start, slot = places.pair_slots(number, own, bits)
        start = start[_marked(pairs, slot)]
        goes_on = np.zeros(len(number) + LONGEST, bool)
        goes_on[start] = True
        number = np.concatenate([number, np.zeros(LONGEST, np.uint64)])
        columns, on = [number[start], number[start + 1]], np.ones(len(start), bool)
        for k in range(2, LONGEST):
            on = on & goes_on[start + k - 1]
            columns.append(np.where(on, number[start + k], np.uint64(0)))
        table = np.stack(columns, 1)
        table = table[np.lexsort(columns[::-1])]
        fresh = np.flatnonzero(np.concatenate([[True], (table[1:] != table[:-1]).any(1)])[: len(table)])
        if len(fresh):
            yield language, table[fresh], np.diff(fresh, append=len(table))


def _bytes(table: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of numbers as bytes, in whose order phrases begin alike, and the bytes of each up to its first 0."""
    raw = table.astype(">u8").view(np.uint8).reshape(len(table), LONGEST, 8)[:, :, 8 - width :]
    return raw.reshape(len(table), LONGEST * width), (table != 0).sum(1) * width


def _table(data: bytes, size: np.ndarray, width: int) -> np.ndarray:
    """The rows of numbers whose bytes, without the zeros behind, follow each other in ``data``."""
    raw = np.zeros((len(size), LONGEST * width), np.uint8)
    raw[np.arange(LONGEST * width) < size[:, None]] = np.frombuffer(data, np.uint8)
    wide = np.zeros((len(size), LONGEST, 8), np.uint8)
    wide[:, :, 8 - width :] = raw.reshape(len(size), LONGEST, width)
    return wide.view(">u8").astype(np.uint64).reshape(len(size), LONGEST)


def _drawn(places: _Places, bits: int, filters, every: int):
    """Rows (lang, key): every so many'th suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, ROOM):
            for language, table, _ in _suffixes(batch, places, bits, filters):
                raw, size = _bytes(table[len(table) % every // 2 :: every], places.width)
                keys = pa.array([row[:n].tobytes() for row, n in zip(raw, size)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(keys), pa.string()), keys], names=["lang", "key"])

    return run


def _every(n: int):
    """Every n'th row of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield batch.take(pa.array(np.arange(-(seen + 1) % n, len(batch), n)))
            seen += len(batch)

    return run


def _splitters(rows: DataFrame, places: _Places, bits: int, filters, ranges: int, total: int) -> dict[str, tuple]:
    """Per language, the range of its first suffix and the bounds of its further ranges.

    Taken from suffixes drawn from some of the texts: they decide which task
    counts a suffix, not what is counted.
    """
    share = min(1.0, DRAWN * THINNED * ranges / max(total, 1))
    every = THINNED if share < 1 else max(1, total // (DRAWN * ranges))
    some = rows if share == 1 else rows.sample(share, 1)
    drawn = some.mapInArrow(_drawn(places, bits, filters, every), "lang string, key binary")
    drawn = drawn.repartitionByRange("lang", "key").sortWithinPartitions("lang", "key")
    bounds = {(r["lang"], bytes(r["key"])) for r in drawn.mapInArrow(_every(DRAWN), drawn.schema).collect()}  # one a range
    found: dict[str, tuple] = {}
    for number, (language, key) in enumerate(sorted(bounds, key=lambda b: (b[0].encode(), b[1]))):
        found.setdefault(language, (number, []))[1].append(key)
    return found


def _routed(places: _Places, bits: int, filters, splits):
    """Rows (route, lang, keys, sizes, counts): the suffixes of a run of texts that lie in one range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splits.value
        languages = sorted(own, key=str.encode)
        for batch in slices(batches, 0, ROOM):
            rows = []
            for language, table, n in _suffixes(batch, places, bits, filters):
                raw, size = _bytes(table, places.width)
                if language in own:
                    first, bounds = own[language]
                    keys = np.ascontiguousarray(raw).view(f"S{raw.shape[1]}")[:, 0]
                    route = first + np.searchsorted(np.array(bounds, keys.dtype), keys, "right")
                else:
                    later = [x for x in languages if x.encode() > language.encode()]
                    last = own[languages[-1]] if languages else (0, [])
                    route = np.full(len(table), own[later[0]][0] if later else last[0] + len(last[1]))
                inside = np.arange(raw.shape[1]) < size[:, None]
                starts = np.flatnonzero(np.diff(route, prepend=-1))
                for a, b in zip(starts, [*starts[1:], len(route)]):
                    packed = raw[a:b][inside[a:b]].tobytes(), size[a:b].astype("u1").tobytes(), n[a:b].astype("<u4").tobytes()
                    rows.append((int(route[a]), language, *packed))
            if rows:
                kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["route", "lang", "keys", "sizes", "counts"])

    return run


def _extreme(table: np.ndarray, pick) -> int:
    """The least or greatest row."""
    rows = np.arange(len(table))
    for column in table.T:
        rows = rows[column[rows] == pick(column[rows])]
    return rows[0]


def frequent_prefixes(table: np.ndarray, n: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(row, words, count) of each prefix of two or more words with ``least`` occurrences.

    Multikey quicksort of row pointers: a part is split in three around a
    pivot in one column, its equal part goes on in the next. Parts too small
    are left as they are. Prefixes of the least and of the greatest row come
    whatever their count, as neighbouring ranges may hold more of them.
    """
    if not len(table):
        return
    ends = (_extreme(table, np.min), _extreme(table, np.max))
    parts = [(np.arange(len(table)), 0, (True, True))]
    while parts:
        rows, depth, at_end = parts.pop()
        if not any(at_end) and n[rows].sum() < least:
            continue
        keys = table[rows, depth]
        pivot = np.sort(keys[:: max(1, len(keys) // 9)])[min(4, (len(keys) - 1) // 2)]
        of_ends = [table[end, depth] for end in ends]
        for part, rule in ((keys < pivot, np.less), (keys > pivot, np.greater)):
            if part.any():
                parts.append((rows[part], depth, tuple(e and bool(rule(k, pivot)) for e, k in zip(at_end, of_ends))))
        if pivot == 0:  # suffixes that end here
            continue
        equal = rows[keys == pivot]
        count, at_end = int(n[equal].sum()), tuple(e and bool(k == pivot) for e, k in zip(at_end, of_ends))
        if depth and (count >= least or any(at_end)):
            yield int(equal[0]), depth + 1, count
        if depth + 1 < LONGEST:
            parts.append((equal, depth + 1, at_end))


def _count_ranges(width: int, least: int):
    """Partial counts of phrases, range by range, from packed rows sorted by range and language."""

    def counted(language: str, rows: list[tuple]) -> pa.RecordBatch:
        keys, sizes, counts = (b"".join(part) for part in zip(*rows))
        table = _table(keys, np.frombuffer(sizes, "u1").astype(np.int64), width)
        found = list(frequent_prefixes(table, np.frombuffer(counts, "<u4").astype(np.int64), least))
        raw, _ = _bytes(table[[row for row, _, _ in found]].reshape(-1, LONGEST), width)
        names = [row[: words * width].tobytes() for row, (_, words, _) in zip(raw, found)]
        columns = [pa.array([language] * len(found), pa.string()), pa.array(names, pa.binary())]
        columns.append(pa.array([count for _, _, count in found], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["lang", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for route, language, *packed in zip(*(column.to_pylist() for column in batch.columns)):
                if (route, language) != current:
                    if rows:
                        yield counted(current[1], rows)
                    current, rows = (route, language), []
                rows.append(packed)
        if rows:
            yield counted(current[1], rows)

    return run


def _part(key: str, first: Column | int, count: Column | int, width: int) -> Column:
    """``count`` words of a key from word ``first`` (0-based)."""
    return F.substring(F.col(key), first * width + F.lit(1), count * F.lit(width))


def _count_phrases(rows: DataFrame, least: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Words and phrases with ``least`` occurrences, words in all per language, and bytes of a number."""
    counted = rows.mapInArrow(_count_words, "lang string, word string, n long")
    words = scratch.write(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    often = F.col("f") >= least
    total, distinct, common = words.agg(F.sum("f"), F.count("*"), F.count_if(often)).first()
    # Numbers as short as will tell every frequent word from all others, but for rare chance.
    width = next((b for b in range(4, 8) if 16 * distinct * common < 1 << 8 * b), 8)
    for seed in range(100):
        named = words.mapInArrow(_numbered(width, seed), "lang string, word string, f long, key binary, slot long")
        alike = named.groupBy("lang", "key").agg(F.count("*").alias("words"), F.max("f").alias("f"))
        if alike.where(often & (F.col("words") > 1)).isEmpty():
            break
    else:
        raise RuntimeError("no numbers tell the words apart")
    frequent = scratch.write(named.where(often), "frequent")

    spark = rows.sparkSession
    bits = max(PAIR_BITS[0], min(PAIR_BITS[1], int(total or 0).bit_length() - 1))
    places = _Places(width, seed, _word_filter(frequent))
    pairs = _pair_filter(rows, places, bits, least)
    filters = spark.sparkContext.broadcast((places.words, pairs))
    light = _Places(width, seed, None)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total or 0) // RANGE_ROWS)
    splits = spark.sparkContext.broadcast(_splitters(rows, light, bits, filters, ranges, int(total or 0)))
    packed = "route int, lang string, keys binary, sizes binary, counts binary"
    routed = rows.mapInArrow(_routed(light, bits, filters, splits), packed)
    last = max((first + len(bounds) for first, bounds in splits.value.values()), default=0)
    routed = routed.repartitionById(last + 1, F.col("route")).sortWithinPartitions("route", "lang")
    partial = routed.mapInArrow(_count_ranges(width, least), "lang string, key binary, n long")
    phrases = partial.groupBy("lang", "key").agg(F.sum("n").alias("f")).where(often)
    phrases = scratch.write(phrases, "phrases")
    filters.unpersist()
    splits.unpersist()
    return frequent.drop("slot"), phrases, words.groupBy("lang").agg(F.sum("f").alias("n")), width


def mine_collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    best: int = 2000,
    contained: int = 100,
) -> DataFrame:
    """Per language, the ``best`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    Words, phrases and counts are per language, a null one being ``und``. Texts
    are cut at .,;:!? and line breaks, A-Z lowered, and cut into words at spaces
    and tabs. ``n`` counts all words, ``a`` the phrase, ``l`` and ``r`` its two
    parts at the cut of the lowest ``score``, floor(1000 a n / (l r)). Phrases
    of two to five words with at least ``least`` occurrences take part, but for
    those that lie in a longer one with ``contained`` percent of their count.
    Null and empty texts hold no words; repeated rows count each time; other
    columns are ignored; an empty table, or one without such a phrase, gives no
    rows. Equal scores rank by count, then by the bytes of the phrase.
    """
    scratch = Scratch(docs.sparkSession)
    language = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), language.alias("lang"))
    words, phrases, totals, width = _count_phrases(rows, least, scratch)
    known = scratch.write(words.select("lang", "key", "f").unionByName(phrases), "known")

    size = F.floor(F.octet_length("key") / width).cast("int")
    candidates = phrases.withColumn("size", size)
    longer = candidates.where("size > 2")
    inner = F.array(_part("key", F.lit(0), F.col("size") - 1, width), _part("key", F.lit(1), F.col("size") - 1, width))
    covering = longer.select("lang", F.explode(inner).alias("key"), "f").groupBy("lang", "key").agg(F.max("f").alias("over"))
    kept = candidates.join(covering, ["lang", "key"], "left")
    kept = kept.where(F.col("over").isNull() | (100 * F.col("over") < contained * F.col("f")))
    kept = scratch.write(kept.select("lang", "key", "size", F.col("f").alias("a")), "kept")

    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", _part("key", F.lit(0), F.col("cut"), width))
    cuts = cuts.withColumn("right", _part("key", F.col("cut"), F.col("size") - F.col("cut"), width))
    for side, name in (("left", "l"), ("right", "r")):
        table = known.select("lang", F.col("key").alias(side), F.col("f").alias(name))
        cuts = lookup(cuts, table, ["lang", side], "inner")
    cuts = lookup(cuts, totals, ["lang"], "inner")
    wide = {c: f"cast({c} as decimal(15, 0))" for c in "alrn"}
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    scored = cuts.groupBy("lang", "key", "a", "n").agg(lowest).select("*", "low.*").drop("low")
    scored = scratch.write(scored, "scored")

    spelt = scored.select("lang", "key", F.posexplode(_split("key", width)).alias("place", "part"))
    spelt = lookup(spelt, words.select("lang", F.col("key").alias("part"), "word"), ["lang", "part"], "inner")
    spelt = spelt.groupBy("lang", "key").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    named = scored.join(spelt, ["lang", "key"]).withColumn("phrase", F.concat_ws(" ", "words.word"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    result = top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    result = materialise(result, "collocations")
    scratch.drop()
    return result


def _split(key: str, width: int) -> Column:
    """The words of a key, one by one."""
    last = F.floor(F.octet_length(key) / width).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col(key), i * width + 1, F.lit(width)))
