"""Totals and averages over trailing periods, days without activity included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Tasks that lay out the calendar, as a multiple of the shuffle partitions.
DENSE_TASKS = 4


def rolling_totals(
    activity: DataFrame, calendar: DataFrame, entity: str, day: str, amount: str, periods: tuple[int, ...] = (7, 30)
) -> DataFrame:
    """(entity, day, total, sum_Nd, avg_Nd for N of ``periods``): a row per entity and calendar day.

    ``activity`` holds (entity, day, amount decimal) in any number of rows, repeated ones included; they
    are added up per entity and day first, combined before the shuffle, so that a hot entity costs one row
    per day and task. ``calendar`` is one row (lo, hi), the first and last day; activity outside it is
    left out. Rows without entity are left out; a row without day only makes its entity known; a null
    amount counts as 0; an entity's amounts may add up to 9e16 at most, beyond that the query fails. avg_Nd is sum_Nd / N: days before the calendar count as days without activity.
    Empty activity, or lo or hi null, gives an empty result. Other columns of ``activity`` are ignored.

    Every entity is crossed with the calendar by exploding, at each of its active days, the days up to
    the next one. Running sums are made on the active days only; over the dense rows the sum of the last
    N days is the running sum less that of N rows before.
    """
    daily = (
        activity.select(F.col(entity).alias("e"), F.col(day).cast("date").alias("d"), F.col(amount).cast("decimal(18,2)").alias("a"))
        .where(F.col("e").isNotNull())
        .crossJoin(F.broadcast(calendar.select(F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi"))))  # one row
        .where(F.col("lo").isNotNull() & F.col("hi").isNotNull() & (F.col("d").isNull() | F.col("d").between(F.col("lo"), F.col("hi"))))
        .groupBy("e", F.coalesce("d", "lo").alias("d"), "lo", "hi")
        .agg((F.coalesce(F.sum(F.when(F.col("d").isNotNull(), F.col("a"))), F.lit(0)) * 100).cast("bigint").alias("total"))  # hundredths
    )
    # the dense rows are many times the active days, so the tasks that make them are not to be merged by size
    tasks = DENSE_TASKS * int(activity.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_day = Window.partitionBy("e").orderBy("d")
    spans = daily.repartition(tasks, "e").select(
        "e",
        "d",
        "total",
        F.sum("total").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.when(F.lag("d").over(by_day).isNull(), F.col("lo")).otherwise(F.col("d")).alias("first"),
        F.date_sub(F.coalesce(F.lead("d").over(by_day), F.date_add("hi", 1)), 1).alias("last"),
    )
    dense = spans.select("e", "d", "total", "run", F.explode(F.sequence("first", "last")).alias("day")).select(
        "e",
        "day",
        F.when(F.col("day") == F.col("d"), F.col("total")).otherwise(0).alias("total"),
        F.when(F.col("day") < F.col("d"), 0).otherwise(F.col("run")).alias("run"),
    )
    rows = Window.partitionBy("e").orderBy("day")
    sums = dense.select("e", "day", "total", *[(F.col("run") - F.lag("run", n, 0).over(rows)).alias(f"s{n}") for n in periods])
    return sums.select(
        F.col("e").alias(entity),
        F.col("day").alias(day),
        (F.col("total") / 100.0).alias("total"),
        *[(F.col(f"s{n}") / 100.0).alias(f"sum_{n}d") for n in periods],
        *[(F.col(f"s{n}") / 100.0 / F.lit(float(n))).alias(f"avg_{n}d") for n in periods],
    )
