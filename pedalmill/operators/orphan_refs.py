"""References to records that do not exist (yet, or any more)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalmill.functions.keys import with_key_number
from pedalmill.operators.skew import salted_left_join

#: Parent keys are cut into blocks of 2 to this power of consecutive integers. A block's runs are one row, which every
#: reference to it is joined with, so a large block costs more per reference than it saves in rows.
BLOCK_BITS = 4


def parent_runs(parents: DataFrame, key: Column, start: Column, end: Column | None = None, bits: int = BLOCK_BITS) -> DataFrame:
    """(shape, block, runs): the parents' keys as runs of consecutive integers.

    A run is struct(first, last, spans): the keys first..last all have records, and spans[n - first] are
    the times in which key n has one, as struct(start, end), end null for ever. Runs of a block are in
    ascending order. Records without a key or a start are left out: they are never live. Of records that
    end together the earliest start tells, so copies of a hot key are merged before the shuffle.
    """
    end = F.lit(None).cast("timestamp_ntz") if end is None else end
    rows = parents.select(key.alias("__key"), start.cast("timestamp_ntz").alias("__from"), end.cast("timestamp_ntz").alias("__to"))
    rows = rows.where(F.col("__key").isNotNull() & F.col("__from").isNotNull())
    unique = (
        with_key_number(rows, "__key")
        .withColumn("block", F.shiftright("n", bits))
        .groupBy("shape", "block", "n", "__to")
        .agg(F.min("__from").alias("__from"))
    )
    # from here on all is clustered by (shape, block): at most 2 ** bits keys, one shuffle for the three steps
    keys = (
        unique.repartition("shape", "block")
        .groupBy("shape", "block", "n")
        .agg(F.collect_list(F.struct(F.col("__from").alias("start"), F.col("__to").alias("end"))).alias("spans"))
    )
    order = Window.partitionBy("shape", "block").orderBy("n")
    return (
        keys.withColumn("island", F.col("n") - F.row_number().over(order))
        .groupBy("shape", "block", "island")
        .agg(F.min("n").alias("first"), F.max("n").alias("last"), F.array_sort(F.collect_list(F.struct("n", "spans"))).alias("ks"))
        .groupBy("shape", "block")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last", F.col("ks.spans").alias("spans")))).alias("runs"))
    )


def find_orphans(refs: DataFrame, row_id: Column, key: Column, at: Column, runs: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """(row_id, at, why) of the references whose key has no live record at the row's time.

    Every reference is matched as of the start of the preceding run of its block; ``why`` is 'missing'
    for keys before the first run or beyond the run's end, 'not_live' for keys whose records live at
    other times only. References that are null, or whose time is null, are no cases. Repeated rows come
    out as often as they come in.
    """
    r = refs.select(row_id.alias("row_id"), key.alias("__key"), at.cast("timestamp_ntz").alias("at"))
    r = with_key_number(r.where(F.col("__key").isNotNull() & F.col("at").isNotNull()), "__key").withColumn("block", F.shiftright("n", bits))
    joined = salted_left_join(r, runs, ["shape", "block"], ["row_id", "at"])
    run = F.try_element_at(F.filter("runs", lambda x: x["first"] <= F.col("n")), F.lit(-1))
    hit = joined.select("row_id", "at", "n", run.alias("run"))
    inside = F.col("run").isNotNull() & (F.col("n") <= F.col("run.last"))
    live = F.exists(
        F.try_element_at(F.col("run.spans"), (F.col("n") - F.col("run.first") + 1).cast("int")),
        lambda s: (s["start"] <= F.col("at")) & (s["end"].isNull() | (F.col("at") < s["end"])),
    )
    why = F.when(~inside, F.lit("missing")).when(~live, F.lit("not_live"))
    return hit.select("row_id", "at", why.alias("why")).where(F.col("why").isNotNull())

