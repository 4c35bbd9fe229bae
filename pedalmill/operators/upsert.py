"""Insert, update and delete by key on immutable tables: anti joins and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalmill.operators.global_rank import global_row_number


def dedup(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order`` (which should tell rows apart); rows with a null key are left out.

    The winner is an aggregate, combined before the shuffle, so a hot key is no hot task. Ties give any
    one of the tied rows, whole.
    """
    present = rows.dropna(subset=keys)
    ranked = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order)])
    rest = [c for c in rows.columns if c not in keys]
    best = present.groupBy(*keys).agg(F.min_by(F.struct(*rest) if rest else F.lit(None), ranked).alias("__r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once; null keys included."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def upsert(target: DataFrame, delta: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """``target`` with the rows of ``delta`` in place of those of the same keys, and its new ones.

    Keys are compared null-safe; ``delta`` should hold a key once. Columns in ``keep`` stay as they were
    for keys that the target has. Applying the same delta again changes nothing.
    """
    match = [target[k].eqNullSafe(delta[k]) for k in keys]
    kept = target.join(delta, match, "left_anti")
    if keep:
        old = target.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"__old_{c}") for c in keep], F.lit(True).alias("__had"))
        on = [delta[k].eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        delta = delta.join(old, on, "left").select(*[F.when(F.col("__had"), F.col(f"__old_{c}")).otherwise(F.col(c)).alias(c) if c in keep else F.col(c) for c in target.columns])
    return kept.unionByName(delta.select(*target.columns))


def delete_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the rows whose keys are in ``gone``."""
    return target.join(gone.select(*keys).distinct(), keys, "left_anti")


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``target`` and the rows of ``new`` whose keys it does not have, one per key."""
    return target.unionByName(dedup(new, keys, order).join(target.select(*keys).distinct(), keys, "left_anti").select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` taken from ``source`` where it has the key and a value, as they were elsewhere.

    ``source`` should hold a key once.
    """
    new = source.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns])
    return target.join(new, keys, "left").select(*[F.coalesce(f"__new_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns])


def next_codes(rows: DataFrame, key: str, first_seen: Column, highest: DataFrame, prefix: str, digits: int) -> DataFrame:
    """(key, code): new codes prefix + number after the highest one in use, in the order in which keys are
    first seen, then by key. ``highest`` is one row (top)."""
    seen = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(first_seen).alias("__seen"))
    numbered = global_row_number(seen, [("__seen", False), (key, False)], "__n")
    return numbered.crossJoin(F.broadcast(highest)).select(key, F.concat(F.lit(prefix), F.lpad((F.col("__n") + F.coalesce("top", F.lit(0))).cast("string"), digits, "0")).alias("code"))
