import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from helpers import documents
from wardspan.llm import token_files
from wardspan.llm.queries import op12_token_files
from wardspan.llm.token_files import _Whole, _Words, read_token_files, token_index, write_token_files

TEXTS = [
    "", None, " ", "a  b\n\n c\t", "<|endoftext|>x <|endoftext|>. <|startoftext|>", "don't I'LL é́ ퟿ 𝒳 \x00\x1c　", "word " * 3000,
    "x" * 5000, "Thntiwh | inesea 123,456... it's. 's! x''s, ́a  b c", "a.\r\nb!?\r\n" * 40, "été où… İstanbul ΣΑΣ. ﬁ",
    "same", "same",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(texts, tokenizer):
    """(doc_id, start, n_tokens, crc32) in ascending order, null ids first."""
    rows, start = [], 0
    for key, text in sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        rows.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    words, whole = _Words("word_bpe_49k.json"), _Whole("word_bpe_49k.json")
    rng = random.Random(1)
    letters = "ab'sStTé́̀ \n\t\r.,;:!?-<|>0١ΣςİÅÅ \u0085​\x0b漢한가\x01$}"
    made = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(4000)]
    made += ["".join(rng.choices(["<|endoftext|>", "<|", "|>", ">", ".", "'", "s", "$", " ", "x"], k=9)) for _ in range(2000)]
    texts = TEXTS + made
    for some in ([], texts[:1], *(texts[i : i + 97] for i in range(0, len(texts), 97))):
        ids, sizes = words.encode(pa.array(some, pa.string()), 2)
        want, lengths = whole.encode(pa.array(some, pa.string()), 2)
        assert ids.tolist() == want.tolist() and sizes.tolist() == lengths.tolist()


def test_words_are_forgotten_beyond_a_bound(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    words, whole = _Words("word_bpe_49k.json"), _Whole("word_bpe_49k.json")
    for i in range(40):
        some = [f"Word{i} word{j}. \x01 \x01a\x01" for j in range(30)]
        assert words.encode(pa.array(some, pa.string()), 2)[0].tolist() == whole.encode(pa.array(some, pa.string()), 2)[0].tolist()
        assert len(words.words.places) < 200 and len(words.parts.places) < 200


def test_files_give_back_the_ids_in_order(spark, tokenizer, tmp_path):
    texts = list(enumerate(TEXTS))
    random.Random(2).shuffle(texts)
    for name, by_word in (("words", True), ("whole", False)):
        path = str(tmp_path / name)
        write_token_files(documents(spark, texts).repartition(5), path, by_word=by_word)
        assert in_order(token_index(spark, path).collect()) == expected(texts, tokenizer)
        for row in read_token_files(spark, path, [3, 9]).collect():
            assert row["ids"] == [*tokenizer.encode(TEXTS[row["doc_id"]], add_special_tokens=False).ids, 2]


def test_query_over_the_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = in_order(op12_token_files(spark, "/root/testdata/sf0.001").collect())
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_repeated_and_null_ids(spark, tmp_path):
    rows = [(None, "a b")] * 3 + [(1, "a b"), (1, "c"), (1, "a b"), (2, None)] + [(7, "x y z")] * 400
    write_token_files(documents(spark, rows).repartition(7), str(tmp_path / "t"))
    got = in_order(token_index(spark, str(tmp_path / "t")).collect())
    assert [r[0] for r in got] == [None] * 3 + [1] * 3 + [2] + [7] * 400
    ends = np.cumsum([r[2] for r in got])
    assert [r[1] for r in got] == [0, *ends[:-1]]
    assert sorted(r[2] for r in got[3:6]) == [2, 3, 3]


def test_hot_id_lies_in_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        write_token_files(documents(spark, [(7, "x y z")] * 400 + [(8, "x")]).repartition(7), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = read_token_files(spark, str(tmp_path / "t")).where("doc_id = 7")
    assert hot.select("part").distinct().count() > 1
    got = in_order(token_index(spark, str(tmp_path / "t")).collect())
    assert [r[1] for r in got] == [4 * i for i in range(401)] and got[-1][0] == 8


def test_empty_table(spark, tmp_path):
    write_token_files(documents(spark, []), str(tmp_path / "t"))
    index = token_index(spark, str(tmp_path / "t"))
    assert index.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and index.count() == 0


def test_stripes_and_pruning(spark, tmp_path):
    """Several stripes a file, none sharing an id range; a search by id pushes its filter to the files."""
    rows = [(i, " ".join(f"w{(i * 7 + j) % 997}" for j in range(60))) for i in range(20_000)]
    write_token_files(documents(spark, rows), str(tmp_path / "t"), stripe_bytes=1 << 17)
    files = sorted((tmp_path / "t").glob("*.orc"))
    spans = []
    for file in files:
        reader = orc.ORCFile(str(file))
        assert reader.compression == "SNAPPY"
        for k in range(reader.nstripes):
            ids = reader.read_stripe(k, columns=["doc_id"]).column(0).to_pylist()
            assert ids == sorted(ids)
            spans.append((ids[0], ids[-1]))
    assert len(spans) > len(files) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    raw = files[0].read_bytes()
    found = read_token_files(spark, str(tmp_path / "t"), [12_345])
    assert "In(doc_id, [12345])" in found._jdf.queryExecution().toString() or "EqualTo(doc_id,12345)" in found._jdf.queryExecution().toString()
    assert [r["doc_id"] for r in found.collect()] == [12_345]
    # Ids written run by run take less than their 4 bytes each.
    tokens = token_index(spark, str(tmp_path / "t")).groupBy().sum("n_tokens").first()[0]
    assert sum(f.stat().st_size for f in files) < 4 * tokens and raw[:3] == b"ORC"


def test_an_encoder_keeps_to_the_core_of_its_task(monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "")
    del os.environ["TOKENIZERS_PARALLELISM"]
    _Words("word_bpe_49k.json")
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
