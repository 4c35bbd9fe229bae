"""Keys as typed in files: cleaning and an order-preserving integer form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What counts as white space around a key.
BLANKS = " \t\r\n\x0b\x0c "

def clean_key(value: Column, dots: bool = False) -> Column:
    """Trimmed, upper-cased key, null where blank; ``dots``: `_` and `-` count as `.`."""
    typed = F.upper(F.btrim(value, F.lit(BLANKS)))
    if dots:
        typed = F.translate(typed, "_-", "..")
    # most keys are clean as they stand; the pattern is cheaper than the repair
    clean = value.rlike("^[A-Z0-9.]+$" if dots else "^[A-Z0-9.-]+$")
    return F.when(clean, value).otherwise(F.nullif(typed, F.lit("")))


def with_key_number(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with shape string and n bigint in place of ``key``.

    n is the number that the key's last digits make, shape what stands before them and how many they are;
    the pair determines the key. A key without digits at its end, or with more than 18, is its own shape
    with n = 0; null keys become '' and 0, so leave them out before. Both are never null for the planner
    as well: else it would put "is not null" of these long expressions into every filter below a join.
    """
    size = F.length(key) - F.length("__head")
    counted = size.between(1, 18)
    return (
        rows.withColumn("__head", F.rtrim(F.col(key), F.lit("0123456789")))
        .withColumn("n", F.coalesce(F.when(counted, F.substr(F.col(key), F.length("__head") + 1).cast("bigint")), F.lit(0).cast("bigint")))
        .withColumn("shape", F.coalesce(F.when(counted, F.concat("__head", F.lit("#"), size.cast("string"))).otherwise(F.col(key)), F.lit("")))
        .drop("__head", key)
    )
