"""Reading Vietnamese postal addresses as typed: house number, street and what may name the province."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalmill.llm.edit import BKTree, damerau, plain
from pedalmill.llm.reference_map import PHRASES, allowed

# Words before the parts of an address. A word with accents must be typed with them or
# without any; another accent is another word.
PROVINCE_MARKS = {"tỉnh", "t", "tp", "thành phố"}
DISTRICT_MARKS = {"huyện", "h", "quận", "q", "thị xã", "tx"}
WARD_MARKS = {"xã", "x", "phường", "p", "ph", "f", "thị trấn", "tt"}
STREET_MARKS = {"đường", "đ", "d", "phố", "thôn", "th", "xóm", "ấp", "ngõ", "hẻm"}
NUMBER_MARKS = {"số", "số nhà", "sn", "nhà"}
NOT_PLACES = {"kho", "địa chỉ", "dc", "đc", "việt nam", "vn", "vietnam"}

_PHONE = re.compile(r"\b(?:sdt|dt|tel|fax|phone|mobile|hotline|dien thoai|so dien thoai)\b\s*[.:]*\s*(?:\(?\+\d{2}\)?[ .-]?)?(?:\d{2}(?:[ .-]\d{2}){4}|\(?\d{2,4}\)?(?:[ .-]{1,2}\d{3,4}){2}|\(?\d{2,4}\)?[ .-]{1,2}\d{6,8}|\d{6,13})(?!\d)")
# What is said of an order after the number.
_ORDER = re.compile(r"[(–-]?\s*(?:\b(?:don \d+ dong|tong \d+ ma|\d+ mon)\b)(?:\s*[,/]?\s*\d+ (?:chiec|xe|dong|mon)\b)*\s*[),]?")
# Notes for the driver, often without a separator before them.
_NOTE = re.compile(r"\b(?:cong (?:sau|truoc|chinh)|gan cho|gui xe khach|giao gio hanh chinh)\b")
_LEFT = re.compile(r"\(\s*(?:truoc|cu\s*:|nguyen la|ten cu)[^)]*\)?")
_NOW = re.compile(r"\bnay\s+(?:la|thuoc)\b")
_OLD = re.compile(r"\(\s*cu\s*\)")
_PAREN = re.compile(r"\([^)]*\)?")
_TOKEN = re.compile(r"[^\s,;()\[\]\"“”]+|[,;]")
_NUMBER = re.compile(r"^\d+[a-z]?(?:[/-]\d*[a-z]?\d*)*$")


@dataclass
class Address:
    """number: the house number or ''; mark: what stands before the street's name; street: its words,
    plain; phrases: what may name a province."""

    number: str = ""
    mark: str = ""
    street: tuple[str, ...] = ()
    phrases: list[tuple[str, bool]] = field(default_factory=list)


def _fold(text: str) -> tuple[str, str]:
    """(lower-case text, its plain form), of the same length, so that places in one are places in the other."""
    low = unicodedata.normalize("NFC", text).lower().replace("﻿", " ")
    low = "".join(c if len(plain(c)) == 1 else " " for c in low)
    return low, plain(low)


def _cut(low: str, flat: str, pattern: re.Pattern) -> tuple[str, str]:
    for m in reversed(list(pattern.finditer(flat))):
        low, flat = low[: m.start()] + " , " + low[m.end() :], flat[: m.start()] + " , " + flat[m.end() :]
    return low, flat


_MARKS = {
    **dict.fromkeys(PROVINCE_MARKS, "province"),
    **dict.fromkeys(DISTRICT_MARKS, "district"),
    **dict.fromkeys(WARD_MARKS, "ward"),
    **dict.fromkeys(STREET_MARKS, "street"),
    **dict.fromkeys(NUMBER_MARKS, "number"),
    **dict.fromkeys(NOT_PLACES, "none"),
}
_MARKS |= {plain(m): kind for m, kind in _MARKS.items() if plain(m) not in _MARKS}
#: Marks long enough to be known with a slip.
_LONG = {plain(m).replace(" ", ""): kind for m, kind in _MARKS.items() if len(m) >= 4}


def _damaged(mark: str) -> set[str]:
    """``mark`` with n or ? in place of some of its letters with accents."""
    return {"".join(c) for c in product(*[(c,) if plain(c) == c else (plain(c), "n", "?") for c in mark.replace(" ", "")])}


#: Marks whose letters with accents are damaged; what is a mark by itself is none.
_DAMAGED = {d: kind for m, kind in _MARKS.items() for d in _damaged(m) if len(d) > 1 and d not in _MARKS and d not in _LONG}


def _split(low: str, flat: str) -> list[tuple[str, str, bool]]:
    """(lower-case token, plain token, ends with a dot?); separators come as ','."""
    out: list[tuple[str, str, bool]] = []
    for m in _TOKEN.finditer(low):
        raw = m.group()
        if raw in ",;" or set(raw) <= set("-–—|*"):
            out.append((",", ",", False))
            continue
        place = m.start()
        # h.luat, tp.benlau, p.12, p15: a short mark glued to what it marks
        glued = re.match(r"([^\W\d_]{1,2})\.(?=\w)", raw)
        if glued and plain(glued.group(1)) in _MARKS:
            out.append((glued.group(1), plain(glued.group(1)), True))
            raw, place = raw[glued.end() :], place + glued.end()
        elif (digits := re.match(r"(p|f|q|ph)(?=\d+$)", plain(raw))) is not None:
            out.append((digits.group(), digits.group(), True))
            raw = raw[digits.end() :]
        while raw:
            word = raw.strip(".:!'")
            dot = raw.endswith(".")
            if not word or set(word) <= set("-–—"):
                break
            # a dash between words separates, in a number it belongs
            if re.search(r"[-–—]", word) and not _NUMBER.match(plain(word)):
                for i, part in enumerate(re.split(r"[-–—]+", word)):
                    if i:
                        out.append((",", ",", False))
                    if part:
                        out.append((part, plain(part), False))
                break
            out.append((word, plain(word), dot))
            break
    return out


def _mark(tokens: list[tuple[str, str, bool]], i: int) -> tuple[str, int]:
    """(kind, number of tokens) of the mark at ``i``; ('', 0) where there is none."""
    if i + 1 < len(tokens) and (two := f"{tokens[i][0]} {tokens[i + 1][0]}") in _MARKS:
        return _MARKS[two], 2
    return (_MARKS[tokens[i][0]], 1) if tokens[i][0] in _MARKS else ("", 0)


def _segment_end(tokens: list[tuple[str, str, bool]], i: int) -> int:
    while i < len(tokens) and tokens[i][0] != ",":
        i += 1
    return i


def parse(text: str | None, names: frozenset[str] = frozenset(), dotted: frozenset[str] = frozenset()) -> Address:
    """What ``text`` says. ``names``: the provinces' names, plain and without blanks, as some hold a word that
    else is a mark (Phuong Hai, Dong Pho); ``dotted``: those with a dot after a letter (Q.Vuc).

    Null, empty and blank texts give an empty Address. A street's name goes on to the next separator, mark or
    province's name, and has two tokens at least where there are two. The names of wards and districts have
    two syllables, or one token with both, or a number.
    """
    out = Address()
    if not text or not text.strip():
        return out
    low, flat = _fold(text)
    low, flat = _cut(low, flat, _ORDER)
    low, flat = _cut(low, flat, _PHONE)
    low, flat = _cut(low, flat, _NOTE)
    low, flat = _cut(low, flat, _LEFT)
    old: list[tuple[str, str, bool]] = []
    now = _NOW.search(flat)
    if now:
        before_low, before_flat = low[: now.start()], flat[: now.start()]
        cut = _OLD.search(before_flat)
        end = cut.start() if cut else len(before_flat)
        # what is marked as former is the last part before the note
        start = max(before_low.rfind(c, 0, end) for c in ",;\n–—") + 1
        if " - " in before_low[start:end]:
            start = before_low.rfind(" - ", start, end) + 3
        old = _split(before_low[start:end], before_flat[start:end])
        low = before_low[:start] + " , " + low[now.end() :]
        flat = before_flat[:start] + " , " + flat[now.end() :]
    low, flat = _cut(low, flat, _PAREN)
    low, flat = low.replace("\n", ","), flat.replace("\n", ",")
    tokens = _split(low.replace("\r", ","), flat)
    if old and len(old) > 3:  # no separator before the former name: its words stay but the last two
        keep = old[:-2]
        while keep and _MARKS.get(keep[-1][0]) == "province":
            keep.pop()
        place = next((k for k in range(len(tokens)) if tokens[k][0] == ","), len(tokens))
        tokens[place:place] = [(",", ",", False), *keep, (",", ",", False)]
    i, n = 0, len(tokens)
    rest: list[str] = []
    marked = False
    waiting = False  # for a street after its number

    def flush() -> None:
        nonlocal rest, marked
        if rest:
            out.phrases.append((" ".join(rest), marked))
        rest, marked = [], False

    while i < n:
        word, flat_word, dot = tokens[i]
        if word == ",":
            flush()
            i += 1
            continue
        if dotted and dot and i + 1 < n and flat_word + tokens[i + 1][1] in dotted:
            flush()
            out.phrases.append((f"{flat_word} {tokens[i + 1][1]}", True))
            i += 2
            continue
        kind, size = _mark(tokens, i)
        end = _segment_end(tokens, i)
        if not waiting and (fits := _named(tokens, i, end, kind, names)):
            rest += [t[1] for t in tokens[i : i + fits]]
            flush()
            i += fits
            continue
        if kind == "number" and not out.number and i + size < n and _NUMBER.match(tokens[i + size][1]):
            i += size
            word, flat_word, dot = tokens[i]
            kind = ""
        if _NUMBER.match(flat_word) and not out.number and not kind:
            flush()
            out.number, waiting = flat_word.upper(), True
            i += 1
            continue
        if waiting:
            # the street's own name may look like a mark; it has two words up to the next part
            words = [t[1] for t in tokens[i:end]]
            stop = next((k for k in range(i + 1, end) if _mark(tokens, k)[0] in ("district", "ward", "province", "number")), end)
            if kind == "street" and not (stop - i == 2 and word in ("pho", "xom", "xóm") and len(words[1]) <= 7):
                out.mark = " ".join(words[:size])
                i += size
                stop = max(stop, i)
            elif kind in ("district", "ward", "province", "none") and stop - i > 2:
                waiting = False
                continue
            elif stop - i >= 3 and (_looks_marked(words[0]) or _DAMAGED.get(words[0]) == "street" or len(words[0]) == 1):
                out.mark = words[0]
                i += 1
            if i >= n or tokens[i][0] == ",":
                i += 1
                continue
            take = _street_size(tokens, i, end, names)
            out.street = tuple(t[1] for t in tokens[i : i + take])
            waiting = False
            i += take
            continue
        if kind in ("district", "ward", "street"):
            flush()
            i += size
            if i < n and tokens[i][0] != ",":
                numeric = tokens[i][1].isdigit()
                i += 1
                if not numeric and i < n and tokens[i][0] != ",":
                    i += 1
            continue
        if kind == "province":
            flush()
            marked = True
            i += size
            continue
        if kind == "none":
            flush()
            i += size
            tokens[i - 1] = (",", ",", False)  # what follows begins a part
            continue
        if kind == "number":
            i += size
            continue
        if end - i == 2 and tokens[i + 1][1].isdigit() and (found := _slipped(tokens[: i + 1], i)) and found[0] in ("ward", "district"):
            i += 2
            continue
        # a mark with a slip at the start of a part of three words or more
        if (i == 0 or tokens[i - 1][0] == ",") and end - i >= 3 and (found := _slipped(tokens, i)):
            flush()
            kind, size = found
            i += size
            if kind == "province":
                marked = True
            else:
                i = min(i + 2, end)
            continue
        rest.append(flat_word)
        i += 1
    flush()
    return out


def _named(tokens: list[tuple[str, str, bool]], i: int, end: int, kind: str, names: frozenset[str]) -> int:
    """Number of tokens at ``i`` that are a province's name though one of them looks like a mark."""
    word, flat_word, dot = tokens[i]
    if kind == "province" and not dot and end - i == 2 and (after := tokens[i + 1][1]) not in names and len(after) <= 5:
        return 2  # a mark before one syllable is a name's first syllable (Tinh Hoa)
    if kind == "street" and not dot and "".join(t[1] for t in tokens[i:end]) in names:
        return end - i  # Phố Đông, where no street is due
    if kind in ("province", "number", "none") or (kind and word != flat_word) or dot or any(_NUMBER.match(t[1]) for t in tokens[i : min(end, i + 3)]):
        return 0
    for size in (3, 2):
        if i + size <= end and "".join(t[1] for t in tokens[i : i + size]) in names and not (kind and end - i == size + 1):
            return size
    at_start = i == 0 or tokens[i - 1][0] == "," or _MARKS.get(tokens[i - 1][0]) == "province"
    if at_start and not kind and 2 <= end - i <= 3 and not any(t[2] or _MARKS.get(t[0]) == "number" for t in tokens[i : end - 1]):
        # a short part that begins without a mark is a name as a whole
        return end - i
    if at_start and kind and len(word) == 1 and end - i == 2 and len(tokens[i + 1][1]) <= 5 and tokens[i + 1][1].isalpha():
        # one letter and one syllable: too short for a marked name, a slip in a name of two syllables
        return 2
    return 0


@lru_cache(maxsize=4)
def _tree(names: frozenset[str]) -> BKTree:
    return BKTree(sorted(names))


def _street_size(tokens: list[tuple[str, str, bool]], i: int, end: int, names: frozenset[str]) -> int:
    """Number of tokens from ``i`` on that are the street's name: up to the next mark, slips allowed, the
    province's name or ``end``. The first two belong to it whatever they look like."""
    first = min(i + 2, end)
    if first == end:
        return end - i
    stop = next((k for k in range(first, end) if _mark(tokens, k)[0] in ("district", "ward", "province", "number")), end)
    named = []
    for k in range(first, stop):
        for last in range(k + 1, min(k + 4, stop) + 1):
            word = "".join(t[1] for t in tokens[k:last])
            named += [(d, -last, k) for d, e in _tree(names).search(word, allowed(len(word) + 1)) if d <= allowed(len(e))]
    if named:
        stop = min(named)[2]
    for k in range(first, stop):
        slipped = k + 1 < end and (_slipped_in_street(tokens, k, stop) or any("".join(t[1] for t in tokens[k : k + size]) in _DAMAGED for size in (2, 1)))
        if slipped or _mark(tokens, k)[0]:
            return k - i
    return stop - i


def _slipped_in_street(tokens: list[tuple[str, str, bool]], k: int, stop: int) -> bool:
    """Does a mark with a slip end the street at ``k``? Short ones are an edit from many a name's syllable (Minh, Xuân
    and Tuấn from tỉnh and quận), so they are taken for marks only before a number or the province's name."""
    found = _slipped(tokens, k)
    if not found:
        return False
    after = k + found[1]
    return sum(len(t[1]) for t in tokens[k:after]) > 5 or after == stop or (after < len(tokens) and tokens[after][1].isdigit())


def _looks_marked(word: str) -> bool:
    return any(kind == "street" and damerau(word, mark) <= 1 for mark, kind in _LONG.items() if abs(len(mark) - len(word)) <= 1)


def _slipped(tokens: list[tuple[str, str, bool]], i: int) -> tuple[str, int] | None:
    for size in (2, 1):
        joined = "".join(t[1] for t in tokens[i : i + size])
        if joined in _LONG:  # a mark's letters with other accents are another word
            continue
        for mark, kind in _LONG.items():
            if kind in ("district", "ward", "province") and abs(len(mark) - len(joined)) <= 1 and damerau(joined, mark) <= 1:
                return kind, size
    return None


def with_parts(rows: DataFrame, address: str, reader: Callable[[str | None], Address]) -> DataFrame:
    """``rows`` with number, mark, words (the street's) and phrases (what may name the province) of the column
    ``address``, '' and empty arrays where it has none. Each address is read once."""

    @F.pandas_udf(f"struct<number:string,mark:string,words:array<string>,phrases:{PHRASES}>")
    def read(batch: pd.Series) -> pd.DataFrame:
        parsed = [reader(a) for a in batch]
        phrases = [[{"text": t, "marked": m} for t, m in p.phrases] for p in parsed]
        return pd.DataFrame({"number": [p.number for p in parsed], "mark": [p.mark for p in parsed], "words": [list(p.street) for p in parsed], "phrases": phrases})

    return rows.withColumn("__p", read(address)).select(*rows.columns, "__p.*")
