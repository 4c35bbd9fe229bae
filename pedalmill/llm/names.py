"""Variant spellings of business names: tokens, phonetic blocks, comparison, clusters."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import permutations, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalmill.llm.components import connected_components
from pedalmill.llm.edit import damerau, plain
from pedalmill.llm.similar import LONG, likeness, lost_letters, rests
from pedalmill.llm.vocabulary import Words, with_infos
from pedalmill.operators.skew import salted_left_join
from pedalmill.session import cut, spread

# Nicknames and short forms in which names are written, and the name they stand for.
NICKNAMES = {
    "ng": "nguyen", "ngx": "nguyen", "tr": "tran", "ph": "pham", "hg": "hoang", "bill": "william", "bob": "robert", "rob": "robert", "dick": "richard", "rick": "richard", "mike": "michael", "jim": "james", "joe": "joseph",
    "tom": "thomas", "tony": "anthony", "ted": "edward", "liz": "elizabeth", "kate": "katherine", "peggy": "margaret", "jack": "john", "chuck": "charles", "hank": "henry", "alex": "alexander",
}
# What is said of legal form, line of business, title or role, and not of the name, with its short forms.
SAID = {
    "cong ty": ("cong ty", "cty", "ct", "c ty"),
    "trach nhiem huu han": ("trach nhiem huu han", "tnhh", "t n h h"),
    "co phan": ("co phan", "cp", "c p", "ctcp"),
    "mot thanh vien": ("mot thanh vien", "mtv", "1 thanh vien"),
    "doanh nghiep": ("doanh nghiep", "dn", "d n"),
    "tu nhan": ("tu nhan", "tn", "t n", "dntn", "d n t n"),
    "ho kinh doanh": ("ho kinh doanh", "ho kd", "ho k doanh", "hkd", "h k d", "ho k d"),
    "cua hang": ("cua hang", "ch", "c h", "cua hieu"),
    "xe dap": ("xe dap", "xe", "xd", "x d", "chxd"),
    "thuong mai": ("thuong mai", "tm", "t m"),
    "dich vu": ("dich vu", "dv", "d v", "tmdv", "t m d v"),
    "va": ("va", "and"),
    "san xuat": ("san xuat", "sx", "s x"),
    "xuat nhap khau": ("xuat nhap khau", "xnk", "x n k", "nhap khau"),
    "dai ly": ("dai ly", "d l", "dl", "npp", "nha phan phoi"),
    "khach hang": ("khach hang", "kh", "k h"),
    "tiem": ("tiem", "shop"),
    "moi": ("moi", "cu"),
    "company": ("company", "co ltd", "ltd", "llc", "inc", "corp", "corporation", "limited", "jsc", "joint stock"),
    "trading": ("trading", "services", "service", "manufacturing", "import export", "bicycle", "bicycles", "private enterprise", "enterprise", "store"),
    "societe": ("societe", "sarl", "sa", "ets", "etablissements", "commerce", "velos", "cycles"),
    "title": ("anh", "chi", "ong", "ba", "bac", "chu", "co", "di", "em", "mr", "ms", "mrs", "dealer"),
}
# Names of nobody.
NOBODY = ("khach le", "khach vang lai")

_PHRASES = sorted({tuple(p.split()) for ps in SAID.values() for p in ps}, key=lambda p: (-len(p), p))
_BY_FIRST: dict[str, list[tuple[str, ...]]] = {}
for _p in _PHRASES:
    _BY_FIRST.setdefault(_p[0], []).append(_p)
#: Phrases long enough to be known with a slip.
_LOOSE = [p for p in _PHRASES if len(p) >= 2 and len("".join(p)) >= 6]

#: Jaro-Winkler similarity from which on two syllables are alike.
ALIKE = 0.5


def tokens(name: str | None) -> list[str]:
    """Plain words of ``name``; a ``?`` stands for a lost letter and belongs to its word."""
    if not name:
        return []
    return re.findall(r"[^\W_]+(?:\?[^\W_]*)*|\?[^\W_]+(?:\?[^\W_]*)*", plain(unicodedata.normalize("NFC", name)))


def strip_said(words: list[str]) -> list[str]:
    """``words`` without what is said of the name, longest phrases first. The last words are never taken
    when nothing else would be left of the name (a dealer called Cong Mai keeps it)."""
    out: list[str] = []
    i = 0
    while i < len(words):
        size = next((len(p) for p in _BY_FIRST.get(words[i], ()) if tuple(words[i : i + len(p)]) == p), 0)
        if size:
            i += size
        else:
            out.append(words[i])
            i += 1
    return out


def strip_slipped(words: list[str], known: frozenset[str] | set[str]) -> list[str]:
    """``words`` without phrases in which one word has a slip; a known syllable is no slip."""
    i = 0
    out: list[str] = []
    while i < len(words):
        size = 0
        for phrase in _LOOSE:
            part = words[i : i + len(phrase)]
            if len(part) == len(phrase):
                off = [(a, b) for a, b in zip(part, phrase, strict=True) if a != b]
                if len(off) <= 1 and all(a not in known and damerau(a, b) <= 1 for a, b in off):
                    size = len(phrase)
                    break
        if size:
            i += size
        else:
            out.append(words[i])
            i += 1
    return out


def phonetic(syllable: str) -> str:
    """A code that sounds alike share: initial and final consonants by class, the vowels by their first."""
    m = re.match(r"^(ngh|ng|nh|ch|tr|th|ph|kh|gh|gi|qu|[bcdghklmnpqrstvxz])?([aeiouy]*)(.*)$", syllable)
    if not m:
        return syllable
    head, vowels, tail = m.group(1) or "", m.group(2), m.group(3)
    initial = {"ngh": "NG", "ng": "NG", "tr": "C", "ch": "C", "s": "S", "x": "S", "d": "Z", "gi": "Z", "r": "Z", "c": "K", "k": "K", "q": "K", "qu": "K", "gh": "G", "g": "G", "l": "N", "n": "N"}
    final = {"c": "K", "ch": "K", "t": "T", "n": "N", "nh": "N", "ng": "N"}
    return initial.get(head, head.upper()) + vowels.replace("y", "i")[:1] + final.get(tail, tail.upper())


def syllables(words: list[str], told: Words, size: int | None = None) -> list[str]:
    """The name's own syllables, each once: run-together ones are split, and where there are more than ``size``,
    phrases with a slip are left out first and then all but the consecutive ``size`` words with most known ones,
    the last such."""
    whole = [s for w in words for s in (told.split(w) if told.spellings(w) == (w,) else [w])]
    if size and len(set(whole)) > size:
        whole = strip_slipped(whole, told.known)
    own = list(dict.fromkeys(whole))
    if size and len(own) > size:
        i = max((sum(w in told.known for w in own[i : i + size]), i) for i in range(len(own) - size + 1))[1]
        own = own[i : i + size]
    return own


def keys(own: list[str], told: Words) -> list[str]:
    """Every set of known syllables that the typed ones may be meant for, as sorted text."""
    return sorted({" ".join(sorted(c)) for c in product(*[told.spellings(w) for w in own])})


def near(x: str, y: str, known: frozenset[str]) -> bool:
    """May two syllables, not both known, be spellings of the same?"""
    if "?" in x + y and min(lost_letters(x, y), lost_letters(y, x)) <= 1:
        return True
    return edits(x, y) <= (1 if x in known or y in known else 2)


def edits(x: str, y: str) -> int:
    """Their distance; of long words that of what differs, where a great difference is far enough."""
    if max(len(x), len(y)) <= LONG:
        return damerau(x, y)
    x, y = rests(x, y)
    return damerau(x, y) if max(len(x), len(y)) <= LONG else LONG


def same_dealer(a: list[str], b: list[str], known: frozenset[str]) -> float:
    """Mean Jaro-Winkler similarity of the syllables of two names in their best order, 0 where they are
    another dealer's: another number of syllables, or a syllable that no other is alike to. Alike are two that are
    not both known, by a similarity of ALIKE or more, and of these the edits are counted."""
    if len(a) != len(b) or not a:
        return 0.0
    rest_a, rest_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    if len(rest_a) != len(rest_b):
        return 0.0
    total = float(len(a) - len(rest_a))
    while rest_a:
        likes = ((likeness(x, y), x, y) for x in rest_a for y in rest_b if not (x in known and y in known))
        best = max((c for c in likes if c[0] >= ALIKE and near(c[1], c[2], known)), default=None)
        if best is None:
            return 0.0
        total += best[0]
        rest_a.remove(best[1])
        rest_b.remove(best[2])
    return total / len(a)


def _name_words(names: pd.Series) -> pd.Series:
    out = []
    for n in names:
        words = tokens(n)
        out.append([] if " ".join(words).startswith(NOBODY) else strip_said(words))
    return pd.Series(out)


def differ(a: list[str], b: list[str], known: frozenset[str]) -> bool:
    """Can two sets of syllables not be meant for the same, whatever the slips? So it is where a known syllable
    of one has no partner in the other; two that are not known may always be the same."""
    rest_a, rest_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return len(rest_a) != len(rest_b) or not any(all(may_be(x, y, known) for x, y in zip(rest_a, ys, strict=True)) for ys in permutations(rest_b))


def may_be(x: str, y: str, known: frozenset[str]) -> bool:
    """May two syllables be meant for the same, with more slips than ``near`` takes as proof?"""
    return x == y or (x not in known and y not in known) or (not (x in known and y in known) and (near(x, y, known) or edits(x, y) <= 2))


def grow(links: list[tuple], differs: Callable[[list[str], list[str], frozenset[str]], bool]) -> dict[str, str]:
    """{spelling: group}, the group's least spelling, of links (score, a, own_a, b, own_b, slip_b, sure), a with a slip,
    sure the known ones of both.

    Groups grow along the links, the best first, at a tie those to a clean spelling, then by name. A link is
    left out only where the grown group would hold two spellings that differ for sure. All that do not
    differ from a clean spelling do not differ from each other, so a group with one is compared by it.
    """
    own: dict[str, list[str]] = {}
    clean: dict[str, str] = {}
    known = frozenset(w for link in links for w in link[6])
    for _, a, own_a, b, own_b, slip_b, _ in links:
        own[a], own[b] = list(own_a), list(own_b)
        if not slip_b:
            clean[b] = b
    group = {x: x for x in own}
    members = {x: [x] for x in own}
    for _, _, a, b in sorted((-round(score, 9), bool(slip_b), a, b) for score, a, _, b, _, slip_b, _ in links):
        x, y = group[a], group[b]
        if x == y:
            continue
        ours, theirs = ([clean[g]] if g in clean else members[g] for g in (x, y))
        if any(differs(own[p], own[q], known) for p in ours for q in theirs):
            continue
        if len(members[x]) < len(members[y]):
            x, y = y, x
        for q in members[y]:
            group[q] = x
        members[x] += members.pop(y)
        if y in clean:
            clean[x] = clean.pop(y)
    return {q: least for ms in members.values() for least in [min(ms)] for q in ms}


def settle(scored: DataFrame, differs: Callable[[list[str], list[str], frozenset[str]], bool]) -> DataFrame:
    """(node, component) of the spellings in the accepted pairs ``scored`` (a with a slip, own_a, b, own_b, slip_b, sure, score).

    Every accepted pair is a link. A component whose spellings are all linked to its only clean one is a
    group; any other is grown link by link, so that it falls apart only where spellings differ for sure.
    Such a component comes to one worker; it has the spellings near to those of a few names.
    """
    scored = cut(scored.select("a", "own_a", "b", "own_b", "slip_b", "sure", "score"))  # used twice
    groups = connected_components(scored.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    links = scored.join(groups.withColumnRenamed("node", "a"), "a")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))
    led = links.where("not slip_b").groupBy("component").agg(F.count_distinct("a").alias("led"), F.count_distinct("b").alias("clean"))
    sure = sizes.join(led, "component").where("clean = 1 and led + clean = nodes").select("component")

    def apart(rows: pd.DataFrame) -> pd.DataFrame:
        found = grow(list(rows[["score", "a", "own_a", "b", "own_b", "slip_b", "sure"]].itertuples(index=False, name=None)), differs)
        return pd.DataFrame(sorted(found.items()), columns=["node", "component"])

    grown = links.join(sure, "component", "left_anti").groupBy("component").applyInPandas(apart, "node string, component string")
    return groups.join(sure, "component", "left_semi").select("node", "component").unionByName(grown)


def cluster_names(rows: DataFrame, ident: str, name: str, size: int | None = None, nicknames: dict[str, str] | None = None) -> DataFrame:
    """(ident, dealer): a dealer id, as text, for every row of ``rows`` whose ``name`` names a dealer.

    Rows with the same dealer id have names of the same syllables, in any order, slips, run-together syllables and
    ``nicknames`` (NICKNAMES by default) allowed, whatever is said of legal form, trade or title. ``size``: a proper
    name has so many syllables at most; what else a longer one holds is left out. Null, empty and
    blank names, those of nobody (Khách lẻ) and names of less than two syllables are left out. Rows come
    out as often as they come in; other columns are ignored.

    Distinct names stand for their copies. What is known of their words is counted over the whole table
    (``vocabulary``). Each set of syllables is blocked by the phonetic codes of its sorted
    syllables, slips standing for every known syllable they may be meant for, so that a block holds the
    spellings of hardly more than one name; typed sets with a slip are compared within their blocks and
    linked to all that they match, and links are closed by connected components, which fall apart only where
    they hold spellings of two names (``settle``).
    """
    named = spread(rows.select(F.col(ident).alias("id"), F.col(name).alias("name")).where("id is not null and name is not null"))
    words = named.withColumn("words", F.pandas_udf(_name_words, "array<string>")("name")).withColumn("key", F.array_join("words", " "))
    words = cut(words.select("id", "key", "words").where("key <> ''"))  # read once for the names and once for their ids
    lists = cut(words.groupBy("key").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("times")))  # equal for equal keys
    told = with_infos(lists, "key", "words", "times", NICKNAMES if nicknames is None else nicknames)

    @F.pandas_udf("struct<own:array<string>,codes:array<string>,slip:boolean,sure:array<string>>")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lists_, infos in batches:
            out = []
            for ws, info in zip(lists_, infos, strict=True):
                said = Words(info)
                own = sorted(syllables(list(ws), said, size))
                codes = {" ".join(sorted(phonetic(s) for s in k.split())) for k in keys(own, said)} if len(own) >= 2 else ()
                out.append((own, sorted(codes), any(w not in said.known for w in own), [w for w in own if w in said.known]))
            yield pd.DataFrame(out, columns=["own", "codes", "slip", "sure"])

    typed = told.withColumn("r", read("words", "infos")).select("key", "r.*").where(F.size("own") >= 2)
    typed = cut(typed.withColumn("rep", F.array_join("own", " ")))  # used three times
    reps = typed.groupBy("rep").agg(*[F.first(c).alias(c) for c in ("own", "codes", "slip", "sure")])  # equal for equal reps
    blocks = reps.select("rep", "own", "slip", "sure", F.explode("codes").alias("code"))
    slips = blocks.where("slip").select(F.col("rep").alias("a"), F.col("own").alias("own_a"), F.col("sure").alias("sure_a"), "code")
    others = blocks.select(F.col("rep").alias("b"), F.col("own").alias("own_b"), F.col("slip").alias("slip_b"), F.col("sure").alias("sure_b"), "code")
    pairs = slips.join(others, "code").where("a <> b").withColumn("sure", F.array_union("sure_a", "sure_b")).select("a", "own_a", "b", "own_b", "slip_b", "sure").distinct()

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b, sure in batches:
            yield pd.Series([same_dealer(list(x), list(y), frozenset(k)) for x, y, k in zip(a, b, sure, strict=True)], dtype=float)

    scored = pairs.withColumn("score", score("own_a", "own_b", "sure")).where("score > 0")
    groups = settle(scored, differ)
    dealers = typed.select("key", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("dealer"))
    # a third of the rows may have one name
    return salted_left_join(words.select("id", "key"), dealers, ["key"], ["id"]).where("dealer is not null").select(F.col("id").alias(ident), "dealer")


def pairs_within(members: DataFrame, ident: str, group: str) -> DataFrame:
    """(ident_a, ident_b), smaller first, of different ids of the same group, each pair once.

    The result asked for lists every pair of a group, so its size is that of the result; ids are made
    unique before, and a group is met by joining, never collected.
    """
    ids = members.select(F.col(ident).alias("i"), F.col(group).alias("g")).where("i is not null and g is not null").distinct()
    a, b = ids.withColumnRenamed("i", "a"), ids.withColumnRenamed("i", "b")
    return a.join(b, "g").where("a < b").select(F.col("a").alias(f"{ident}_a"), F.col("b").alias(f"{ident}_b")).distinct()

