"""The corpus operators as queries over whole tables."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardspan.llm.collocations import mine_collocations
from wardspan.llm.decontaminate import decontaminate
from wardspan.llm.embedding_dedup import embedding_near_duplicates
from wardspan.llm.jaccard_join import ngram_jaccard_join
from wardspan.llm.licences import scan_licences
from wardspan.llm.main_text import extract_main_text
from wardspan.llm.packing import pack
from wardspan.llm.pii import KINDS, find_pii
from wardspan.llm.quality import resample
from wardspan.llm.sharding import histogram_shards
from wardspan.llm.token_files import token_index, write_token_files
from wardspan.llm.toxicity import fit_weights, labelled_texts, score_toxicity
from wardspan.llm.vector_codes import compress_vectors
from wardspan.operators.skew import lookup
from wardspan.sources.readers import read_parquet
from wardspan.sources.stage import shared_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, folder, "documents"))


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_near_duplicates(_table(spark, folder, "embeddings"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    weights = fit_weights(labelled_texts(docs, _table(spark, folder, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return score_toxicity(docs, weights).select("doc_id", held_out.alias("held_out"), "score", "predicted", "clauses")


def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licences(_table(spark, folder, "documents"))
    base = F.filter("places", lambda p: p.base)
    labels = lambda places: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p.label))))
    starts = F.transform("base", lambda p: p.start)
    return found.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p.share)), F.lit(0.0)).alias("score"),
    )


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    sizes = F.transform("places", lambda p: (p.end - p.start + 1).cast("long"))
    hit = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _joined(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    )


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_pii(_table(spark, folder, "documents"))
    base = KINDS[:4]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    own = F.filter("spans", lambda s: s.kind.isin(*base))
    return found.select(
        "doc_id", *map(count, base), F.sha2(_joined(own), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return resample(_table(spark, folder, "documents"), _table(spark, folder, "labels")).drop("text")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return histogram_shards(_table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_main_text(_table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all usable vectors; the errors of equal labels, null ones together, are summed."""
    found = compress_vectors(_table(spark, folder, "embeddings"), keep=["label"])
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))
    codes = found.codes.withColumn("of_label", label)
    sums = codes.groupBy("of_label").agg(F.sum("error").alias("label_error"))
    numbers = ",".join(str(x) for entries in found.codebooks for x in entries.ravel().tolist())
    two_digits = F.transform("code", lambda entry: F.lower(F.lpad(F.hex(entry), 2, "0")))
    return lookup(codes, sums, ["of_label"], "inner").select(
        "vec_id",
        F.concat_ws("", two_digits).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """What the files hold of each document, read back from them; nulls and repeats as the writer states."""
    path = f"{shared_folder(spark)}/wardspan/token-files-{uuid.uuid4().hex}"
    write_token_files(_table(spark, folder, "documents"), path)
    return token_index(spark, path)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of all documents, by language; nulls and empty texts as the operator states."""
    return mine_collocations(_table(spark, folder, "documents"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_licences": op4_licences,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii": op6_pii,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_sharding": op9_sharding,
    "op10_main_text": op10_main_text,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_files": op12_token_files,
    "op13_collocations": op13_collocations,
}
