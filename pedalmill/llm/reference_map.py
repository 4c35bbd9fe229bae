"""Free-entered values mapped to the closest entry of a reference list."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalmill.llm.edit import BKTree, damerau, plain
from pedalmill.operators.skew import salted_left_join
from pedalmill.session import cut

#: Entries of one tree. A larger reference list is cut into shards of so many, one tree each.
SHARD_ENTRIES = 20_000


def allowed(length: int) -> int:
    """Edits that a spelling of so many letters may be away from its entry."""
    return 0 if length <= 4 else 1 if length <= 7 else 2


def spelling(name: str) -> str:
    """A name as the tree holds it: plain, without blanks and dots."""
    return plain(name).replace(" ", "").replace(".", "")


class Shard:
    """A tree over the spellings of some entries; lookups are remembered per worker."""

    def __init__(self, entries: list[tuple[int, str]]) -> None:
        self.ids: dict[str, int] = {}
        self.codes: set[str] = set()
        #: Words that an entry may be typed in: some more than it has, as one may be typed apart.
        self.most_words = 2 + max((len(name.replace(".", " ").split()) for _, name in entries), default=0)
        for ident, name in entries:
            key = spelling(name)
            self.ids[key] = min(ident, self.ids.get(key, ident))
            if " " not in name.strip() and (name == name.upper() or "." in name):
                self.codes.add(key)
        self.ids.pop("", None)
        self.tree = BKTree(sorted(self.ids))
        self.known: dict[str, list[tuple[int, int, str, int]]] = {}

    def lookup(self, word: str) -> list[tuple[int, int, str, int]]:
        """(distance, -length, entry, id) of every entry within the threshold of ``word``, best first."""
        hits = self.known.get(word)
        if hits is None:
            if len(self.known) > 200_000:
                self.known.clear()
            found = self.tree.search(word, allowed(max(len(word), 1) + 1))
            hits = sorted((d, -len(e), e, self.ids[e]) for d, e in found if d <= allowed(len(e)))
            self.known[word] = hits
        return hits

    def best(self, phrases: list[tuple[str, bool]]) -> tuple | None:
        """The nearest entry named by any of ``phrases``: marked before unmarked at the same distance, whole
        phrases before parts of them, later ones before earlier ones, then the lower id."""
        won = None
        for place, (phrase, marked) in enumerate(phrases):
            words = [w for w in phrase.replace(".", " ").split() if w]
            for size in range(1, min(len(words), self.most_words) + 1):
                for i in range(len(words) - size + 1):
                    whole = size == len(words)
                    for d, length, entry, ident in self.lookup("".join(words[i : i + size])):
                        if d > (0 if not whole and entry in self.codes else 1 if not whole or entry in self.codes else 2):
                            continue
                        rank = (d, not marked, not whole, length, -place, entry, ident)
                        if won is None or rank < won:
                            won = rank
        return won


def _winners(shard: Shard, phrases: pd.Series) -> pd.DataFrame:
    won = [None if ps is None else shard.best([(p["text"], p["marked"]) for p in ps]) for ps in phrases]
    return pd.DataFrame(
        {
            "rank": [None if w is None else [w[0], int(w[1]), int(w[2]), w[3], w[4]] for w in won],
            "entry": [None if w is None else w[5] for w in won],
            "id": pd.array([None if w is None else w[6] for w in won], dtype="Int32"),
        }
    )


#: A type of ``phrases`` and of ``match``.
PHRASES = "array<struct<text:string,marked:boolean>>"
WINNER = "struct<rank:array<int>,entry:string,id:int>"
#: Values that a tree is asked for at once where the list has many shards.
BLOCK_VALUES = 50_000


def map_to_reference(rows: DataFrame, value: str, phrases: str, reference: DataFrame, spread_by: list[str], shard_entries: int = SHARD_ENTRIES, block_values: int = BLOCK_VALUES) -> DataFrame:
    """``rows`` with ``match``: struct(rank, entry, id) of the closest entry named by ``value``, null where none is.

    ``reference`` has (id int, name string); null names are left out, an id may have many names, a name
    many ids (the lowest wins). ``phrases`` is the column of the parts of the value that may name an entry, each with
    whether the text says so; it should depend on ``value`` alone. Ties go to the lower id. Rows are neither dropped
    nor merged; a null value, or one without phrases, has no match.

    A list of up to ``shard_entries`` distinct entries, which is counted, is one tree, broadcast, and no row is
    shuffled. A longer one is cut by hash into shards of about half as many, and distinct values into blocks of about
    ``block_values``: each pair of a shard and a block is a task's work, whose size does not grow with either, and the
    shards' winners of a value are merged by rank. ``spread_by``: columns whose hash spreads the rows of a value that
    many have.
    """
    spark = rows.sparkSession
    entries = reference.select(F.col("id").cast("int").alias("id"), F.col("name").cast("string").alias("name")).where("id is not null and name is not null").distinct()
    count = entries.count()
    if count <= shard_entries:
        shared = spark.sparkContext.broadcast(sorted((r.id, r.name) for r in entries.collect()))  # shard_entries at most

        @F.pandas_udf(WINNER)
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            shard = Shard(shared.value)
            for batch in batches:
                yield _winners(shard, batch)

        out = rows.withColumn("match", find(phrases))
        return out.withColumn("match", F.when(F.col("match.id").isNotNull(), F.col("match")))
    shards = -(-2 * count // shard_entries)
    asked = cut(rows.where(F.col(value).isNotNull() & (F.size(phrases) > 0)).groupBy(F.col(value).alias("__value")).agg(F.first(phrases).alias("phrases")))  # equal for equal values
    blocks = max(1, -(-asked.count() // block_values))
    left = asked.withColumn("block", F.pmod(F.xxhash64("__value"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = entries.withColumn("shard", F.pmod(F.xxhash64("name", "id"), F.lit(shards)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(values: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(values) or not len(part):
            return pd.DataFrame({"__value": [], "rank": [], "entry": [], "id": []}, dtype=object)
        won = _winners(Shard(list(zip(part["id"], part["name"], strict=True))), values["phrases"])
        won.insert(0, "__value", values["__value"].to_numpy())
        return won[won["id"].notna()]

    kind = asked.schema["__value"].dataType.simpleString()
    hits = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(meet, f"__value {kind}, rank array<int>, entry string, id int")
    won = hits.groupBy("__value").agg(F.min_by(F.struct("rank", "entry", "id"), F.struct("rank", "entry", "id")).alias("match"))
    keyed = rows.withColumn("__value", F.coalesce(F.col(value), F.lit("")) if kind == "string" else F.col(value))
    return salted_left_join(keyed, won, ["__value"], spread_by).drop("__value")
