"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of the left rows on; so at most HEAVY_SHARE ** -1 keys are heavy.
HEAVY_SHARE = 1 / 500
#: Salts of a heavy key at a share of 1; a key holding a third is spread over a third of these.
SALTS = 768


def heavy_keys(left: DataFrame, keys: list[str], share: float = HEAVY_SHARE, salts: int = SALTS) -> DataFrame:
    """(keys, __salts): the keys holding at least ``share`` of the rows, never more than 1 / share rows.

    Counts are combined before the shuffle, so a hot key costs one row per task.
    """
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"))
    return (
        counts.crossJoin(F.broadcast(total))  # one row
        .where(F.col("__n") >= F.col("__all") * share)
        .select(*keys, F.greatest(F.lit(2), F.ceil(F.col("__n") / F.col("__all") * salts)).cast("int").alias("__salts"))
    )


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """left LEFT JOIN right on non-null ``keys``, heavy keys of ``left`` spread over many tasks.

    ``right`` should hold few rows per key, as its rows of heavy keys are repeated once per salt.
    ``spread`` names columns of ``left`` whose hash picks the salt; it is deterministic, so that a task
    run again puts every row where it was.
    """
    heavy = F.broadcast(heavy_keys(left, keys))  # at most 1 / HEAVY_SHARE rows
    salted = left.join(heavy, keys, "left").withColumn(
        "__salt", F.when(F.col("__salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread), F.col("__salts")).cast("int"))
    )
    repeated = right.join(heavy, keys, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))
    )
    return salted.drop("__salts").join(repeated.drop("__salts"), [*keys, "__salt"], "left").drop("__salt")
