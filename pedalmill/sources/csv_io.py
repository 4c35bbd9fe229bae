"""Staging files: CSV with a byte-order mark, a header and text columns."""

from __future__ import annotations

import csv
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """All columns as text, names and values trimmed, '' as null; quoted values may hold line ends.

    The mark before the first name is dropped. Raises ValueError where a required column is missing.
    """
    raw = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    named = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    missing = [c for c in required or [] if c not in named.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return named.select(*[F.nullif(F.trim(f"`{c}`"), F.lit("")).alias(c) for c in named.columns])


def write_csv(df: DataFrame, folder: str) -> None:
    """A folder of CSV files with headers, one per task; '' for null."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "").csv(folder)


def export_csv(df: DataFrame, path: str, most_rows: int = 100_000) -> int:
    """One CSV file with a byte-order mark, for people; raises ValueError beyond ``most_rows``. Number of rows."""
    rows = df.limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows; write_csv writes any number")
    fd, part = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)), suffix=".part")
    with os.fdopen(fd, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(df.columns)
        w.writerows(["" if v is None else v for v in r] for r in rows)
    os.replace(part, path)
    return len(rows)
