"""Queries of the training-data operators."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.llm.address import Address, parse, with_parts
from pedalmill.llm.mixture import mix
from pedalmill.llm.names import cluster_names, pairs_within
from pedalmill.llm.reference_map import map_to_reference, spelling
from pedalmill.llm.residue import find_residue
from pedalmill.llm.same_address import cluster_addresses
from pedalmill.llm.tokenizer import with_ids
from pedalmill.session import spread
from pedalmill.sources.tables import table


def _provinces(spark: SparkSession, d: str) -> DataFrame:
    """(id, name) by every name of a province; a mark before a name (TP.) may be left out."""
    names = table(spark, d, "province").select(F.col("province_id").alias("id"), F.col("province_name").alias("name"))
    names = names.unionByName(table(spark, d, "province_alias").select(F.col("province_id").alias("id"), F.col("alias").alias("name")))
    bare = names.withColumn("name", F.regexp_replace("name", "^(?i)(tp|t)\\. +", ""))
    return names.unionByName(bare).where("id is not null and name is not null").distinct()


#: Names that the address parser may be told; a longer list of provinces is an error.
MOST_NAMES = 100_000


def _reader(provinces: DataFrame) -> partial[Address]:
    """The address parser, told the provinces' names that look like other parts of an address."""
    told = provinces.select("name").limit(MOST_NAMES + 1).collect()  # two fixed tables, of under 100 names
    if len(told) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names of provinces")
    names = frozenset(spelling(r.name) for r in told)
    dotted = frozenset(spelling(r.name) for r in told if "." in r.name and len(r.name.split(".")[0].strip()) == 1)
    return partial(parse, names=names, dotted=dotted)


def placed_customers(spark: SparkSession, d: str) -> DataFrame:
    """staging_customer with its address as read (number, mark, words, phrases) and the province found in it
    (found_id, 0 where none). An address is read once."""
    provinces = _provinces(spark, d)
    rows = spread(table(spark, d, "staging_customer").select("customer_code", "address", "province_id", "created_at"))
    found = map_to_reference(with_parts(rows, "address", _reader(provinces)), "address", "phrases", provinces, ["customer_code"])
    return found.withColumn("found_id", F.coalesce("match.id", F.lit(0)))


def p1_map(spark: SparkSession, d: str) -> DataFrame:
    """Every staged customer with the province its address names, the name matched and its distance."""
    found = placed_customers(spark, d)
    return found.select(
        "customer_code",
        "address",
        F.col("province_id").alias("staged_id"),
        F.col("found_id").alias("province_id"),
        F.col("match.entry").alias("matched_name"),
        F.col("match.rank")[0].alias("distance"),
        F.when(F.coalesce(F.trim("address"), F.lit("")) == "", "EMPTY").when(F.col("found_id") == 0, "UNMATCHED").otherwise("MATCHED").alias("status"),
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Of a code delivered twice the row created last tells."""
    found = placed_customers(spark, d)
    last = F.max_by(F.struct("province_id", "found_id"), F.struct("created_at", "address", "province_id"))
    one = found.where("customer_code is not null").groupBy("customer_code").agg(last.alias("r"))
    wrong = F.col("r.province_id").isNull() | (F.col("r.province_id") != F.col("r.found_id"))
    return one.where(wrong).select("customer_code", F.col("r.found_id").alias("province_id"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = placed_customers(spark, d).where("found_id <> 0")
    return pairs_within(cluster_addresses(found, "customer_code", "found_id", "number", "mark", "words"), "customer_code", "place")


#: Syllables of a dealer's proper name.
SYLLABLES = 4


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    dealers = cluster_names(table(spark, d, "staging_customer"), "customer_code", "customer_name", SYLLABLES)
    return pairs_within(dealers, "customer_code", "dealer")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return with_ids(spread(table(spark, d, "documents").select("doc_id", "text")), "text", ["doc_id"])


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixture itself, a row per block."""
    return mix(table(spark, d, "documents"), table(spark, d, "mix_target"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Per target: what its source has, what was used of it, and its share as reached."""
    mixture, plans = mix(table(spark, d, "documents"), table(spark, d, "mix_target"))
    used = mixture.groupBy("source").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("slots"), (F.max("turn") + 1).alias("times"))
    schema = "source string, target_share double, max_repeats int, available_tokens bigint"
    goals = spark.createDataFrame([(p.source, p.share, p.repeats, p.tokens) for p in plans], schema)
    total = used.agg(F.sum("used").alias("whole"))
    return (
        goals.join(used, "source", "left")
        .crossJoin(F.broadcast(total))  # one row
        .select(
            "source",
            "target_share",
            "max_repeats",
            "available_tokens",
            F.coalesce("used", F.lit(0)).alias("used_tokens"),
            F.coalesce("slots", F.lit(0)).alias("blocks_used"),
            F.coalesce("times", F.lit(0)).alias("most_uses"),
            F.coalesce(F.try_divide(F.col("used").cast("double"), F.col("whole").cast("double")), F.lit(0.0)).alias("actual_share"),
        )
    )


def p10_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The residue documents with what was found in each, and the evidence of title and host."""
    return find_residue(table(spark, d, "documents"), "doc_id", "text", "source").select("doc_id", F.array_join("reasons", ",").alias("reasons"), "host", "mismatched", "titles")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return find_residue(table(spark, d, "documents"), "doc_id", "text", "source").select("doc_id").distinct()


QUERIES = {
    "p1_found": p1_found,
    "p1_map": p1_map,
    "p5_found": p5_found,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_reasons": p10_reasons,
}

ORACLES: dict[str, str] = {}
