import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helpers import documents
from wardspan.llm.packing import pack, piece_lengths, write_buckets
from wardspan.llm.queries import op8_packing

TEXTS = [
    "", None, " ", "a  b\n\n c\t", "<|endoftext|>x <|endoftext|>", "don't I'LL é́ ퟿ 𝒳 \x00\x1c　", "word " * 3000,
    "x" * 5000, "Thntiwh | inesea 123,456", "\r\n" * 40, "été où…",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer, longest=1024):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for key, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[key], key=lambda r: r.start)
        assert [p.length for p in pieces] == piece_lengths(len(ids), longest)
        assert {p.doc_tokens for p in pieces} == {len(ids)} and sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert (p["ids"] == part) if "ids" in p else (p.ids_crc32 == zlib.crc32(part))
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    assert all(r.length & (r.length - 1) == 0 for r in rows)


def test_pieces_give_back_the_ids(spark, tokenizer):
    texts = list(enumerate(TEXTS))
    check(pack(documents(spark, texts)).collect(), texts, tokenizer)
    check(pack(documents(spark, texts), longest=16).collect(), texts, tokenizer, 16)


def test_query_over_the_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(op8_packing(spark, "/root/testdata/sf0.001").collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_odd_rows_and_buckets(spark, tmp_path):
    rows = [(None, "a b"), (1, "a b"), (1, "a b"), (2, None)]
    packed = pack(documents(spark, rows))
    assert sorted((r.doc_id or 0, r.length) for r in packed.collect()) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1)]
    assert pack(documents(spark, rows).where("false")).count() == 0
    write_buckets(packed, str(tmp_path / "packed"))
    assert sorted(p.name for p in (tmp_path / "packed").glob("length=*")) == ["length=1", "length=2"]
    with pytest.raises(ValueError):
        pack(documents(spark, rows), longest=100)
