"""A corpus from raw documents to packed sequences, as stages over tables.

Each stage takes (spark, docs, folder) and returns a table that is written and
read again as the next stage's docs. All but the last keep the columns of
``documents``. Rows a stage rejects are gone for the later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardspan.llm.decontaminate import without_contaminated
from wardspan.llm.jaccard_join import ngram_jaccard_join
from wardspan.llm.packing import pack
from wardspan.llm.pii import redact_column
from wardspan.llm.toxicity import fit_weights, labelled_texts, score_column
from wardspan.sources.readers import read_parquet
from wardspan.sources.stage import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose text isn't predicted toxic, by weights learned from labelled ones of ``docs``."""
    weights = fit_weights(labelled_texts(docs, read_parquet(spark, f"{folder}/labels.parquet")))
    return docs.where(score_column("text", weights) < 0.5)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the least id of each class of near copies; of rows equal in id and text, one.

    Rows that share an id but not their text are documents of their own. Rows
    with a null id are in no class and all stay.
    """
    named, key = docs.where("doc_id is not null"), "doc_id"
    if not named.groupBy("doc_id").count().where("count > 1").isEmpty():
        key = "_row"  # in the order of ids
        named = named.dropDuplicates(["doc_id", "text"]).repartitionByRange("doc_id", "text")
        named = named.sortWithinPartitions("doc_id", "text").withColumn(key, F.monotonically_increasing_id())
        named = materialise(named, "numbered")
    classes = ngram_jaccard_join(named, id_col=key)
    kept = classes.where(F.col(key) == F.col("component_id")).select(key).distinct()
    named = named.join(kept, key, "left_semi")
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return without_contaminated(docs, read_parquet(spark, f"{folder}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows."""
    clean = docs.withColumn("text", redact_column("text"))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document's token ids, in sequences whose lengths are powers of two."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: The grammar's weights and the tokens have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage's table written to the shared folder before the next."""
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
