"""Ranks over all rows without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalmill.session import cut


def global_row_number(df: DataFrame, order: list[tuple[str, bool]], name: str = "rn", buckets: int | None = None) -> DataFrame:
    """``df`` with ``name`` bigint, 1 for the first row of the order (columns and whether descending).

    The order's columns should tell all rows apart; nulls come first when ascending and last when descending.
    Rows are range-partitioned into ``buckets`` (the session's shuffle partitions, which grow with the cluster's
    data), by cut points that Spark samples from all input partitions; the partition's number is checkpointed, so
    that it stays what it was when a task is run again. Each bucket is numbered on its own and shifted by the rows
    before it, so a rank never depends on the sample. An empty input stays empty.
    """
    keys = [F.col(c).desc() if d else F.col(c).asc() for c, d in order]
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(n, *keys).withColumn("__bucket", F.spark_partition_id()))
    sizes = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))  # one row per bucket
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (
        placed.withColumn("__rn", F.row_number().over(Window.partitionBy("__bucket").orderBy(*keys)))
        .join(F.broadcast(offsets), "__bucket")
        .withColumn(name, (F.col("__rn") + F.col("__before")).cast("bigint"))
        .drop("__bucket", "__rn", "__before")
    )


def global_quantiles(df: DataFrame, value: str, shares: dict[str, float], weight: str | None = None) -> DataFrame:
    """One row: for every (name, share) the exact quantile of the double column ``value``, interpolated linearly,
    as double; null without values. Nulls are left out. A row counts as often as its ``weight`` says, or once.

    Equal values are counted before they are ranked, so what is ranged is distinct values, and no task holds
    them all: running counts over range buckets tell which value stands at which place.
    """
    counted = df.select(F.col(value).cast("double").alias("v"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("w"))
    counts = counted.where("v is not null").groupBy("v").agg(F.sum("w").alias("w"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(counts.repartitionByRange(n, "v").withColumn("__bucket", F.spark_partition_id()))
    sizes = placed.groupBy("__bucket").agg(F.sum("w").alias("__n"))  # one row per bucket
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    total = sizes.agg(F.sum("__n").alias("__all"))
    inside = Window.partitionBy("__bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        placed.withColumn("end", F.sum("w").over(inside))
        .join(F.broadcast(offsets), "__bucket")
        .crossJoin(F.broadcast(total))  # one row
        .withColumn("end", F.col("end") + F.col("__before"))
    )
    aggs = []
    for name, share in shares.items():
        at = F.lit(float(share)) * (F.col("__all") - 1)
        held = lambda place: F.min(F.when(F.col("end") > place, F.col("v")))  # noqa: E731  the value at a place counted from 0
        low, high, part = held(F.floor(at)), held(F.ceil(at)), F.max(at - F.floor(at))
        aggs.append((low + (high - low) * part).alias(name))
    return ends.agg(*aggs)


def ntile(rn: Column, n: Column, k: int) -> Column:
    """The tile of row ``rn`` of ``n`` in ``k`` tiles, larger tiles first, as SQL's NTILE."""
    q, r = F.floor(n / k), n % k
    return F.when(rn <= r * (q + 1), F.ceil(rn / (q + 1))).otherwise(r + F.ceil((rn - r * (q + 1)) / F.greatest(q, F.lit(1)))).cast("int")


def quantile_bin(rn: Column, n: Column, k: int) -> Column:
    """The bin of row ``rn`` when ranks 1..n are cut at their linear k-quantiles, edges to the lower bin."""
    return F.greatest(F.lit(1), F.ceil(F.lit(k) * (rn - 1) / F.greatest(n - 1, F.lit(1)))).cast("int")
