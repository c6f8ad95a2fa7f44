"""Packing of token ids into sequences whose lengths are powers of two.

Each document is cut into pieces after the binary digits of its length, the
longest first, and a piece is a sequence of its own. No sequence crosses
documents and none needs padding: batches are drawn from the bucket of one
length. Every document is handled alone, so there is no exchange at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of ids after which rows are handed on.
ROOM = 4 << 20


_encoders: dict = {}


def _encoder(vocabulary: str):
    """Encoder of a rank file, found by name among the installed vocabularies or by path.

    Ids equal those of the JSON vocabulary of the same name in ``tokenizers``,
    its end-of-text mark included; the rank file is several times faster.
    """
    if vocabulary in _encoders:
        return _encoders[vocabulary]
    import base64
    import os

    import public_tokenizers
    import tiktoken

    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    _encoders[vocabulary] = tiktoken.Encoding(
        "ranks",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={"<|endoftext|>": len(ranks)},
    )
    return _encoders[vocabulary]


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """``tokens`` as whole ``longest`` pieces and then its binary digits, falling."""
    whole, rest = divmod(tokens, longest)
    return [longest] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _packer(vocabulary: str, longest: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        names = ["id", "start", "length", "ids", "doc_tokens"]
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encoder.encode(text or "", allowed_special="all"), end], "<u4")
                start = 0
                for length in piece_lengths(len(ids), longest):
                    rows.append((key, start, length, ids[start : start + length].tobytes(), len(ids)))
                    start += length
                    held += 4 * length + 64
                    if held > ROOM:
                        yield _batch(rows, batch.schema.field(0).type, names)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, batch.schema.field(0).type, names)

    return run


def _batch(rows: list[tuple], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    types = [key, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.tiktoken",
    longest: int = 1024,
    end: int = 0,
) -> DataFrame:
    """One row per sequence: ``<id_col>``, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the token ids as little-endian unsigned 32-bit numbers; a
    document is its ids followed by ``end``. ``longest`` is a power of two.
    ``sequence_id`` differs for every sequence and ``offset`` is 0, as a
    sequence is one piece. A null or empty text has the end id alone; repeated
    rows and null ids are packed like any other; other columns are ignored; an
    empty table gives no sequence. A text of any length is taken whole.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = rows.mapInArrow(
        _packer(vocabulary, longest, end), f"id {kind}, start long, length long, ids binary, doc_tokens long"
    )
    return pieces.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write sequences under one folder per length, ready for batches of one length."""
    packed.write.partitionBy("length").parquet(path)
