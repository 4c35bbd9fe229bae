"""Postal addresses of the same place written differently."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalmill.llm.edit import damerau
from pedalmill.llm.names import may_be, near, settle
from pedalmill.llm.vocabulary import Words, with_infos
from pedalmill.operators.skew import salted_left_join
from pedalmill.session import cut

# Short forms of the words before a street's name and the word they stand for.
ABBREVIATIONS = {"d": "duong", "duong": "duong", "pho": "pho", "th": "thon", "thon": "thon", "xom": "xom", "ap": "ap", "ngo": "ngo", "hem": "hem", "n": "duong"}

#: Bands of the signature and hashes per band: two sets of shingles that share half of their members meet
#: in a band with a probability over 0.999999, with three tenths 0.99.
BANDS, ROWS = 48, 2
#: Letters of a q-gram.
Q = 2
#: Costs of the alignment: opening and lengthening a gap, a gap of a street's mark, a slip, two marks of
#: different kinds, and another word. An address pair is accepted up to ACCEPT.
GAP_OPEN, GAP_NEXT, MARK_GAP, SLIP, MARK_KIND, OTHER, ACCEPT = 1.0, 0.6, 0.2, 0.3, 0.2, 4.0, 0.9

_SEEDS = np.random.default_rng(17).integers(1, 2**61 - 1, size=(BANDS * ROWS, 2), dtype=np.uint64) | np.uint64(1)


def shingles(words: list[str], forms: Callable[[str], tuple[str, ...]]) -> list[str]:
    """Tokens and padded q-grams of ``words``, of a word with a slip those of all that it may be meant for."""
    out = set()
    for place, word in enumerate(words):
        for form in forms(word):
            out.add(f"t{place}{form}")
            padded = f"^{form}$"
            out.update(f"{place}{padded[k : k + Q]}" for k in range(len(padded) - Q + 1))
    return sorted(out)


def signature(members: list[str]) -> list[int]:
    """Hashes of the bands of the MinHash signature of a set."""
    base = np.array([xxhash.xxh64_intdigest(m) for m in members], np.uint64)
    least = (base[None, :] * _SEEDS[:, :1] + _SEEDS[:, 1:]).min(axis=1).reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(band.tobytes()) >> 1 for band in least]


def unmarked(words: list[str], known: frozenset[str]) -> list[str]:
    """``words`` of a street without a first one that is a mark with a slip: no known syllable, an edit away
    from a mark, and two words at least left."""
    slipped = len(words) > 2 and words[0] not in known and any(len(m) > 2 and damerau(words[0], m) <= 1 for m in ABBREVIATIONS)
    return words[1:] if slipped else words


def align(a: list[tuple[str, str]], b: list[tuple[str, str]], known: frozenset[str]) -> float:
    """Cost of the best affine-gap alignment of two token sequences; tokens are (kind, word), with kind
    'number', 'mark' or 'street'. A number or a known word never stands for another."""

    def swap(x: tuple[str, str], y: tuple[str, str]) -> float:
        if x[0] != y[0]:
            return OTHER
        if x[1] == y[1]:
            return 0.0
        if x[0] == "mark":
            return 0.0 if ABBREVIATIONS.get(x[1], x[1]) == ABBREVIATIONS.get(y[1], y[1]) else MARK_KIND
        if x[0] == "number" or (x[1] in known and y[1] in known) or not near(x[1], y[1], known):
            return OTHER
        return SLIP

    far = 1e9
    n, m = len(a), len(b)
    match = [[far] * (m + 1) for _ in range(n + 1)]
    gap_a = [[far] * (m + 1) for _ in range(n + 1)]
    gap_b = [[far] * (m + 1) for _ in range(n + 1)]
    match[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                match[i][j] = min(match[i - 1][j - 1], gap_a[i - 1][j - 1], gap_b[i - 1][j - 1]) + swap(a[i - 1], b[j - 1])
            if i:
                opened, longer = (MARK_GAP, MARK_GAP) if a[i - 1][0] == "mark" else (GAP_OPEN, GAP_NEXT)
                gap_a[i][j] = min(min(match[i - 1][j], gap_b[i - 1][j]) + opened, gap_a[i - 1][j] + longer)
            if j:
                opened, longer = (MARK_GAP, MARK_GAP) if b[j - 1][0] == "mark" else (GAP_OPEN, GAP_NEXT)
                gap_b[i][j] = min(min(match[i][j - 1], gap_a[i][j - 1]) + opened, gap_b[i][j - 1] + longer)
    return min(match[n][m], gap_a[n][m], gap_b[n][m])


def other_street(a: list[str], b: list[str], known: frozenset[str]) -> bool:
    """Can two streets not be the same, whatever the slips?"""
    return len(a) != len(b) or not all(may_be(v, w, known) for v, w in zip(a, b, strict=True))


def cluster_addresses(placed: DataFrame, ident: str, province: str, number: str, mark: str, words: str) -> DataFrame:
    """(ident, place): a place id, as text, for every row of read addresses with a province, house number and street.

    Rows with the same place have the same house number in the same street of the same province; slips
    and run-together syllables in the street's name (the array ``words``) and its ``mark`` may differ. Rows
    without one of the three are left out. Rows come out as often as they come in; other columns are ignored.

    Distinct (province, number, street) stand for their copies. What is known of the streets' words is counted over
    the whole table. Streets of the same province and number that meet in a band of their MinHash signatures are
    candidates, affine-gap alignment verifies them; a spelling with a slip is linked to all that it matches, and links
    are closed by connected components, which fall apart only where they hold two streets (``settle``).
    """
    parts = (
        placed.select(F.col(ident).alias("id"), F.col(province).alias("province"), F.col(number).alias("number"), F.coalesce(F.col(mark), F.lit("")).alias("mark"), F.col(words).alias("words"))
        .where((F.col("number") != "") & (F.size("words") > 0) & F.col("id").isNotNull() & F.col("province").isNotNull())
    )
    parts = cut(parts)  # read once for the streets and once for the ids
    streets = cut(parts.groupBy("words").agg(F.count(F.lit(1)).alias("times")).withColumn("street", F.array_join("words", " ")))
    told = with_infos(streets, "street", "words", "times")

    def spell(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lists, infos in batches:
            out = []
            for typed, info in zip(lists, infos, strict=True):
                said = Words(info)
                own = [s for w in unmarked(list(typed), said.known) for s in (said.split(w) if said.spellings(w) == (w,) else [w])]
                out.append((own, any(w not in said.known for w in own), signature(shingles(own, said.spellings)), [w for w in own if w in said.known]))
            yield pd.DataFrame(out, columns=["own", "slip", "bands", "sure"])

    spelt = told.withColumn("s", F.pandas_udf(spell, "struct<own:array<string>,slip:boolean,bands:array<bigint>,sure:array<string>>")("words", "infos")).select("street", "s.*")
    keys = ["province", "number"]
    typed = parts.groupBy(*keys, "words").agg(F.min("mark").alias("mark")).withColumn("street", F.array_join("words", " "))
    # a third of the addresses may be in one street
    typed = salted_left_join(typed.drop("words"), spelt, ["street"], keys).withColumn("rep", F.concat_ws("|", F.col("province").cast("string"), "number", F.array_join("own", " ")))
    typed = cut(typed)  # used three times
    reps = typed.groupBy("rep").agg(*[F.first(c).alias(c) for c in (*keys, "own", "slip", "bands", "sure")], F.min("mark").alias("mark"))  # equal for equal reps but the mark, of which the least is taken
    banded = reps.select("rep", *keys, "mark", "own", "slip", "sure", F.posexplode("bands").alias("band", "hash"))
    at = [*keys, "band", "hash"]
    slips = banded.where("slip").select(*at, F.col("rep").alias("a"), F.col("mark").alias("mark_a"), F.col("own").alias("own_a"), F.col("sure").alias("sure_a"))
    others = banded.select(*at, F.col("rep").alias("b"), F.col("mark").alias("mark_b"), F.col("own").alias("own_b"), F.col("slip").alias("slip_b"), F.col("sure").alias("sure_b"))
    pairs = slips.join(others, at).where("a <> b").withColumn("sure", F.array_union("sure_a", "sure_b")).drop("band", "hash", "sure_a", "sure_b", "province").distinct()

    def verify(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for numbers, *sides, sure in batches:
            costs = []
            for n, ma, sa, mb, sb, known in zip(numbers, *sides, sure, strict=True):
                a, b = ([("number", n), *([("mark", m)] if m else []), *(("street", w) for w in s)] for m, s in ((ma, sa), (mb, sb)))
                costs.append(align(a, b, frozenset(known)))
            yield pd.Series(costs, dtype=float)

    scored = pairs.withColumn("cost", F.pandas_udf(verify, "double")("number", "mark_a", "own_a", "mark_b", "own_b", "sure"))
    scored = scored.where(F.col("cost") <= ACCEPT).withColumn("score", 10.0 - F.col("cost"))
    groups = settle(scored, other_street)
    places = typed.select(*keys, "street", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(*keys, "street", F.coalesce("component", "rep").alias("place"))
    ids = parts.select("id", *keys, F.array_join("words", " ").alias("street"))
    return salted_left_join(ids, places, [*keys, "street"], ["id"]).select(F.col("id").alias(ident), "place")
