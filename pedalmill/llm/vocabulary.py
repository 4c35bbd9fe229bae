"""What a table's own words tell of each of them: which are known, and what a slip or a run-together word is meant for."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalmill.llm.similar import LONG, SIMILAR, likeness, lost_letters, one_edit
from pedalmill.operators.skew import salted_left_join
from pedalmill.session import cut

#: A word is a slip of one that is so many times as frequent and one edit away.
SLIP_RATIO = 8
#: A word that occurs less often is not known, whatever is near to it.
LEAST = 2


def _keys(word: Column) -> Column:
    """Keys of which two words share one that are an edit or a swap of neighbours apart, unless both have one letter
    only: the word itself and what is left of it without one of its letters; of a long one, whose letters are many, its
    first and its last half, for the edit leaves one of them as it was. Halves are those of the shorter of two words."""
    size = F.length(word)
    less = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, size)))
    short = F.filter(F.array_distinct(F.concat(F.array(word), less)), lambda x: x != "")
    half = lambda m: F.floor((m - 2) / 2).cast("int")
    ends = [F.concat_ws("|", m.cast("string"), F.lit(end), part) for m in (size - 1, size) for end, part in (("^", F.substring(word, F.lit(1), half(m))), ("$", F.substring(word, size - half(m) + 1, size)))]
    none = F.array().cast("array<string>")
    return F.concat(F.when(size <= LONG, short).otherwise(none), F.when(size >= LONG - 1, F.array(*ends)).otherwise(none))


def _is_slip(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for typed, meant in pairs:
        yield pd.Series([one_edit(a, b) and likeness(a, b) >= SIMILAR * (len(a) > 2) for a, b in zip(typed, meant, strict=True)], dtype=bool)


def _is_lost(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for typed, meant in pairs:
        yield pd.Series([lost_letters(a, b) <= 1 for a, b in zip(typed, meant, strict=True)], dtype=bool)


def vocabulary(lists: DataFrame, words: str, times: str, nicknames: dict[str, str] | None = None) -> DataFrame:
    """(word, n, known, spellings, halves), a row per word of the array column ``words``; n counts a list ``times``.

    ``spellings``: the words that it may be meant for, itself where there is none: those an edit away that are
    ``SLIP_RATIO`` times as frequent, for a word with lost letters (?) else those that fit it. ``halves``: the two
    words that it is run together from: such as stand side by side in other lists at least as often as it occurs,
    or, where it occurs less than ``LEAST`` times, any two that are known; the more frequent ones, then the later.
    ``known``: it occurs ``LEAST`` times and is neither a slip nor run together. All is found by joins on shared
    keys, so the vocabulary may be of any size, and what is said of a word depends on nothing but the words near
    to it. An empty input gives an empty result.
    """
    at = lists.select(F.col(times).alias("t"), F.posexplode(words).alias("i", "word"), F.col(words).alias("w"))
    counts = cut(at.where("word is not null and word <> ''").groupBy("word").agg(F.sum("t").alias("n")))
    keyed = counts.select("word", "n", F.explode(_keys(F.col("word"))).alias("key"))
    typed, meant = keyed.withColumnsRenamed({"word": "a", "n": "na"}), keyed.withColumnsRenamed({"word": "b", "n": "nb"})
    close = typed.join(meant, "key").where((F.col("a") != F.col("b")) & (F.col("nb") >= SLIP_RATIO * F.col("na"))).select("a", "b").distinct()
    slips = close.where(F.pandas_udf(_is_slip, "boolean")("a", "b"))
    near = cut(slips.groupBy("a").agg(F.sort_array(F.collect_set("b")).alias("spellings")).withColumnRenamed("a", "word"))
    # lost letters that no word an edit away explains: words of the same length are matched with these letters, and
    # one more, blanked, long ones half by half; the patterns of a length are as many as the places of lost letters
    lost = counts.where(F.contains("word", F.lit("?"))).join(near, "word", "left_anti").select(F.col("word").alias("a"), F.length("word").alias("size"))
    gone = F.filter(F.sequence(F.lit(1), F.col("size")), lambda i: F.substring("a", i, F.lit(1)) == "?")
    extra = F.explode(F.when(F.col("size") <= LONG, F.sequence(F.lit(1), F.col("size"))).otherwise(F.array(F.lit(0))))
    blanked = lost.withColumn("gone", gone).withColumn("extra", extra).withColumn("places", F.array_sort(F.array_union("gone", F.array("extra"))))

    def masks(word: str) -> Column:
        size, places = F.col("size"), F.col("places")
        whole = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.when(F.array_contains(places, i), "?").otherwise(F.substring(word, i, F.lit(1)))), "")
        half = (size / 2).cast("int")
        return F.explode(F.when(size <= LONG, F.array(whole)).otherwise(F.array(F.concat(F.lit("^"), F.substring(whole, F.lit(1), half)), F.concat(F.lit("$"), F.substring(whole, half + 1, size)))))

    masked = blanked.select("a", "size", "places", masks("a").alias("mask"))
    patterns = blanked.select("size", "places").distinct()
    whole = counts.where(~F.contains("word", F.lit("?"))).select(F.col("word").alias("b"), F.length("word").alias("size"))
    fits = whole.join(patterns, "size").select("b", "size", "places", masks("b").alias("mask"))
    found = masked.join(fits, ["size", "places", "mask"]).select("a", "b").distinct().where(F.pandas_udf(_is_lost, "boolean")("a", "b"))
    filled = found.groupBy("a").agg(F.sort_array(F.collect_set("b")).alias("spellings")).withColumnRenamed("a", "word")
    sure = cut(counts.join(near.unionByName(filled), "word", "left"))
    # run together: of two neighbours, or, for a word met but once, of any two
    base = sure.where(F.col("spellings").isNull() & (F.col("n") >= LEAST)).select("word", "n")
    first, second = base.withColumnsRenamed({"word": "x", "n": "nx"}), base.withColumnsRenamed({"word": "y", "n": "ny"})
    pairs = at.select("t", F.col("word").alias("x"), F.get("w", F.col("i") + 1).alias("y")).where("length(x) > 1 and length(y) > 1")
    beside = pairs.groupBy("x", "y").agg(F.sum("t").alias("together")).withColumn("word", F.concat("x", "y"))
    alone = sure.where("spellings is null")
    by_pair = beside.join(alone.select("word", "n"), "word").where("together >= n").select("word", "x", "y")
    # only where both halves are as long as some known word: the lengths that occur are few, whatever a word's own
    lengths = base.agg(F.collect_set(F.length("word")).alias("lengths"))
    at_length = F.filter("lengths", lambda k: (k >= 2) & F.array_contains(F.col("lengths"), F.length("word") - k) & (F.length("word") - k >= 2))
    cuts = alone.where((F.col("n") < LEAST) & (F.length("word") >= 4)).crossJoin(F.broadcast(lengths)).withColumn("k", F.explode(at_length))  # one row
    by_half = cuts.select("word", F.substring("word", F.lit(1), F.col("k")).alias("x"), F.substring("word", F.col("k") + 1, F.length("word")).alias("y"))
    split = by_pair.unionByName(by_half).join(first, "x").join(second, "y").where((F.col("word") != F.col("x")) & (F.col("word") != F.col("y")))
    halves = split.groupBy("word").agg(F.max_by(F.array("x", "y"), F.struct(F.least("nx", "ny"), "x")).alias("halves"))
    out = sure.join(halves, "word", "left")
    if nicknames:
        table = F.create_map(*[F.lit(x) for pair in nicknames.items() for x in pair])  # a fixed list
        meant_by = counts.select(F.col("word").alias("name"), F.col("n").alias("names")).where(F.col("n") >= LEAST)
        nick = out.withColumn("name", F.try_element_at(table, F.col("word"))).where("name is not null and name <> word").select("word", "name").join(meant_by, "name").select("word", "name")
        out = out.join(nick, "word", "left").withColumns(
            {"spellings": F.when(F.col("name").isNull(), F.col("spellings")), "halves": F.when(F.col("name").isNotNull(), F.array("name")).otherwise(F.col("halves"))}
        )
    known = (F.col("n") >= LEAST) & F.col("spellings").isNull() & F.col("halves").isNull()
    return out.select("word", "n", known.alias("known"), F.coalesce("spellings", F.array("word")).alias("spellings"), F.coalesce("halves", F.array().cast("array<string>")).alias("halves"))


def with_infos(lists: DataFrame, key: str, words: str, times: str, nicknames: dict[str, str] | None = None) -> DataFrame:
    """``lists`` with infos, an array of what ``vocabulary`` says of each of its words. ``key`` tells the lists apart;
    a word may be in a third of them, so the join by word is salted."""
    vocab = cut(vocabulary(lists, words, times, nicknames))
    single = lists.select(key, F.explode(F.array_distinct(words)).alias("word"))
    told = salted_left_join(single, vocab, ["word"], [key]).where("known is not null")
    per = told.groupBy(key).agg(F.collect_list(F.struct("word", "n", "known", "spellings", "halves")).alias("infos"))  # a list's own words
    return lists.join(per, key, "left")


class Words:
    """What is told of the words of one list."""

    def __init__(self, infos: list) -> None:
        self.told = {i["word"]: i for i in infos if i is not None}
        self.known = frozenset(w for w, i in self.told.items() if i["known"]) | {h for i in self.told.values() for h in i["halves"]}

    def spellings(self, word: str) -> tuple[str, ...]:
        """The words that ``word`` may be meant for: itself where it is no slip."""
        return tuple(self.told[word]["spellings"]) if word in self.told else (word,)

    def split(self, word: str) -> list[str]:
        """The words that ``word`` stands for: two that it is run together from, the name of a nickname, or itself."""
        halves = list(self.told[word]["halves"]) if word in self.told else []
        return halves or [word]
