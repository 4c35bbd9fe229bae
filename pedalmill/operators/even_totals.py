"""Totals per key that take evenly long though a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums are kept in two int64 accumulators, of value // _LIMB and value % _LIMB, so that none overflows.
_LIMB = 10**9
#: A split's dictionary is written out when it has so many keys; what it holds is summed up later anyway.
DICTIONARY = 1 << 18


def _units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Decimals of scale 2 and precision up to 18 as int64 hundredths; null as 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ints = pc.cast(pc.multiply(pc.fill_null(pc.cast(column, pa.decimal128(18, 2)), 0), pa.scalar(100, pa.int64())), pa.int64(), safe=False)
    return ints.to_numpy(zero_copy_only=False)


def _accumulate(n_values: int, dictionary: int):
    """The task: encode keys into dense ids, scatter rows into arrays, give the arrays out as blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[str | None, int] = {}
        counts = np.zeros(1024, np.int64)
        sums = [(np.zeros(1024, np.int64), np.zeros(1024, np.int64)) for _ in range(n_values)]

        def out() -> pa.RecordBatch:
            n = len(ids)
            columns = [pa.array(list(ids), pa.string()), pa.array(counts[:n])]
            for high, low in sums:
                columns += [pa.array(high[:n]), pa.array(low[:n])]
            return pa.RecordBatch.from_arrays(columns, names=["k", "n", *[f"{p}{i}" for i in range(n_values) for p in "hl"]])

        for batch in batches:
            encoded = batch.column(0).dictionary_encode(null_encoding="encode")
            local = np.fromiter((ids.setdefault(k, len(ids)) for k in encoded.dictionary.to_pylist()), np.int64, len(encoded.dictionary))
            codes = local[encoded.indices.to_numpy(zero_copy_only=False)]
            if len(ids) > len(counts):
                size = max(len(ids), 2 * len(counts))
                counts = np.pad(counts, (0, size - len(counts)))
                sums = [(np.pad(h, (0, size - len(h))), np.pad(x, (0, size - len(x)))) for h, x in sums]
            counts += np.bincount(codes, minlength=len(counts))
            for i, (high, low) in enumerate(sums):
                units = _units(batch.column(1 + i))
                np.add.at(high, codes, units // _LIMB)
                np.add.at(low, codes, units % _LIMB)
            if len(ids) >= dictionary:
                yield out()
                ids = {}
                counts[:] = 0
                for high, low in sums:
                    high[:] = 0
                    low[:] = 0
        if ids:
            yield out()

    return run


def even_totals(rows: DataFrame, key: Column, values: dict[str, Column] | None = None, dictionary: int = DICTIONARY) -> DataFrame:
    """(key, n_rows, one sum per value) of ``rows``, nulls of the key as a group of their own.

    Every input split, all of about the same size, encodes its keys into dense ids and adds its rows into
    arrays by those ids; the arrays are then summed by key over the splits. A key costs one row per split
    however many rows it has, so no task gets more than the others. ``values`` are decimals of scale 2
    within decimal(18,2); a null adds 0; sums are exact decimal(38,2). An empty input gives an empty
    result; columns of ``rows`` that are not asked for are ignored, whatever their names.
    """
    values = values or {}
    narrow = rows.select(key.alias("k"), *[v.cast("decimal(18,2)").alias(f"v{i}") for i, v in enumerate(values.values())])
    schema = "k string, n bigint" + "".join(f", h{i} bigint, l{i} bigint" for i in range(len(values)))
    blocks = narrow.mapInArrow(_accumulate(len(values), dictionary), schema)
    wide = "decimal(38,0)"
    total = {
        name: ((F.sum(F.col(f"h{i}").cast("decimal(20,0)")).cast(wide) * F.lit(_LIMB).cast("decimal(10,0)") + F.sum(F.col(f"l{i}").cast("decimal(20,0)"))) / 100)
        for i, name in enumerate(values)
    }
    return blocks.groupBy("k").agg(F.sum("n").alias("n_rows"), *[c.cast("decimal(38,2)").alias(name) for name, c in total.items()])


def frequent_keys(totals: DataFrame, share: float) -> DataFrame:
    """(k, n_rows) of the non-null keys that hold at least ``share`` of all rows, those of null keys counted in."""
    whole = totals.agg(F.sum("n_rows").alias("__all"))
    return (
        totals.crossJoin(F.broadcast(whole))  # one row
        .where(F.col("k").isNotNull() & (F.col("n_rows") >= F.col("__all") * F.lit(share)))
        .select("k", "n_rows")
    )
