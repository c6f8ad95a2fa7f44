"""The retail star schema seen as hospital tables, so that every operator can
run on it: customers as patients, orders as admissions, parts of line items as
diagnoses, line items as prescriptions and lab results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardspan.operators.skew import lookup
from wardspan.plans.features import FeatureParams, Sources

# Four of the five order priorities are kept; the last type is absent.
TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "9-SCHEDULED")

# Lab item by line number 1..7 and line status; 99991 to 99993 are untracked
# and creatine kinase (50910) never occurs.
ITEMS_F = (50912, 51222, 51002, 50813, 50862, 50983, 99991)
ITEMS_O = (50889, 51237, 50912, 51222, 50813, 99992, 99993)


# Columns read, stated so that no file is opened to find the schema.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_acctbal double",
    "part": "p_partkey long, p_brand string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def admissions(spark: SparkSession, folder: str) -> DataFrame:
    stay = F.make_dt_interval((F.col("o_orderkey") % 40).cast("int"))
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("admittime"),
        (F.col("o_orderdate") + stay).alias("dischtime"),
        F.col("o_orderpriority").alias("admission_type"),
    )


def patients(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in debt play the patients whose age is not known."""
    known = F.col("c_acctbal") >= 0
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("subject_id"),
        F.when(known, F.lit(1992) + (F.col("c_custkey") % 7).cast("int")).alias("anchor_year"),
        F.when(known, F.lit(25) + (F.col("c_custkey") % 60).cast("int")).alias("anchor_age"),
    )


def diagnoses(spark: SparkSession, folder: str) -> DataFrame:
    """The brand of every line item, written "Brand#.4" like a dotted code."""
    brand = F.col("p_brand")
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("partkey"), "p_brand")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"), F.col("l_partkey").alias("partkey")
    )
    code = F.concat(F.substring(brand, 1, 6), F.lit("."), F.substring(brand, 7, 9))
    return lookup(lines, part, ["partkey"], "inner").select("hadm_id", code.alias("icd_code"))


def code_map(spark: SparkSession) -> DataFrame:
    """Brands 1 to 20 fall into six groups, the others into none."""
    return spark.range(1, 21, 1, 1).select(
        F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("icd_code"),
        F.concat(F.lit("G"), (F.col("id") % 6).cast("string")).alias("comorbidity"),
    )


def weights(spark: SparkSession) -> DataFrame:
    return spark.range(0, 6, 1, 1).select(
        F.concat(F.lit("G"), F.col("id").cast("string")).alias("comorbidity"),
        (F.col("id") * 2 - 3).cast("double").alias("w_readmit"),
        (F.col("id") - 2).cast("double").alias("w_mortality"),
    )


def prescriptions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("hadm_id"))


def labevents(spark: SparkSession, folder: str) -> DataFrame:
    """Quantities as results, those over 45 missing. The order key packs ship
    date, part, supplier and line number into one number."""
    line = F.col("l_linenumber")
    itemid = F.when(
        F.col("l_linestatus") == "F", F.element_at(F.array(*map(F.lit, ITEMS_F)), line)
    ).otherwise(F.element_at(F.array(*map(F.lit, ITEMS_O)), line))
    order_key = F.expr(
        "cast(unix_date(cast(l_shipdate as date)) as decimal(7, 0)) * 10000000000000000000000000BD"
        " + cast(l_partkey as decimal(12, 0)) * 10000000000000BD"
        " + cast(l_suppkey as decimal(12, 0)) * 10BD + cast(l_linenumber as decimal(1, 0))"
    ).cast("decimal(38, 0)")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"),
        itemid.alias("itemid"),
        F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("valuenum"),
        order_key.alias("labevent_id"),
    )


def sources(spark: SparkSession, folder: str) -> Sources:
    return Sources(
        admissions=admissions(spark, folder),
        patients=patients(spark, folder),
        diagnoses=diagnoses(spark, folder),
        prescriptions=prescriptions(spark, folder),
        labevents=labevents(spark, folder),
        code_map=code_map(spark),
        weights=weights(spark),
    )


PARAMS = FeatureParams(types=TYPES)
