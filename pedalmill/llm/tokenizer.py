"""Byte-level BPE as a transducer over bytes, made deterministic as texts come by."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where the vocabulary's ranks are; a parameter of all that needs them.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the pattern that splits a text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words and states remembered per worker; when full, memory is cleared and filled anew.
REMEMBERED = 150_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """{token: rank} of a file of lines "base64 rank"."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class Transducer:
    """Tokens of byte strings in one pass.

    What a BPE vocabulary makes of a string is the one chain of tokens of which every neighbouring pair
    stays apart when merged on its own. So the last token of each prefix follows from those of shorter
    prefixes, and a state need only hold the last token given out and the bytes read since. A token is
    given out as soon as the chains of all places where a longer token may still be growing agree on it.
    States and transitions are made when they are first met.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.open = {token[:k] for token in ranks for k in range(1, len(token))}
        self.apart: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple[int, bytes], list] = {}
        self.start = self._state(-1, b"")

    def merged(self, data: bytes) -> list[bytes]:
        """The vocabulary's tokens of a short string by its definition: the lowest-ranked merge first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def stay_apart(self, a: int, b: int) -> bool:
        got = self.apart.get((a, b))
        if got is None:
            left, right = self.tokens[a], self.tokens[b]
            got = self.merged(left + right) == [left, right]
            self.apart[a, b] = got
        return got

    def _state(self, last: int, pending: bytes) -> list:
        """[transitions by byte, last token given out, pending bytes, tokens at the end of input]"""
        state = self.states.get((last, pending))
        if state is None:
            state = [{}, last, pending, None]
            self.states[last, pending] = state
        return state

    def _chain(self, last: int, data: bytes) -> list[tuple[int, int] | None]:
        """For every prefix of ``data``, after the token ``last``: (its last token, where that begins), or
        None where its own tokens do not end at ``last``; no token grows from there any more."""
        ends: list[tuple[int, int] | None] = [(last, -1)]
        for end in range(1, len(data) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = self.ranks.get(data[begin:end]) if ends[begin] is not None else None
                if token is not None and (ends[begin][0] < 0 or self.stay_apart(ends[begin][0], token)) and self.merged_alone(token):
                    ends.append((token, begin))
                    break
            else:
                ends.append(None)
        if ends[-1] is None:
            raise ValueError("the vocabulary lacks a token for one of these bytes: " + data.hex())
        return ends

    def merged_alone(self, token: int) -> bool:
        """Do the merges make this token at all?"""
        got = self.apart.get((token, -1))
        if got is None:
            got = self.merged(self.tokens[token]) == [self.tokens[token]]
            self.apart[token, -1] = got
        return got

    @staticmethod
    def _back(ends: list[tuple[int, int]], place: int) -> list[int]:
        out = []
        while place > 0:
            out.append(place)
            place = ends[place][1]
        return out[::-1]

    def _step(self, state: list, byte: int) -> tuple[list, tuple[int, ...]]:
        data = state[2] + bytes((byte,))
        ends = self._chain(state[1], data)
        growing = [p for p in range(len(data)) if ends[p] is not None and data[p:] in self.open] + [len(data)]
        common = self._back(ends, growing[0])
        for place in growing[1:]:
            chain = self._back(ends, place)
            n = next((k for k, (x, y) in enumerate(zip(common, chain, strict=False)) if x != y), min(len(common), len(chain)))
            common = common[:n]
        out = tuple(ends[p][0] for p in common)
        base = common[-1] if common else 0
        return self._state(out[-1] if out else state[1], data[base:]), out

    def encode(self, data: bytes) -> list[int]:
        """Token ids of ``data``, which is one piece of the pattern."""
        state, out = self.start, []
        for byte in data:
            move = state[0].get(byte)
            if move is None:
                move = state[0][byte] = self._step(state, byte)
            state, given = move
            if given:
                out += given
        if state[3] is None:
            ends = self._chain(state[1], state[2])
            state[3] = tuple(ends[p][0] for p in self._back(ends, len(state[2])))
        out += state[3]
        if len(self.states) > REMEMBERED:
            self.states.clear()
            self.start = self._state(-1, b"")
        if len(self.apart) > 4 * REMEMBERED:
            self.apart.clear()
        return out


class Utf8:
    """Bytes to characters as they come, one state per sequence begun; what is no UTF-8 gives U+FFFD."""

    def __init__(self) -> None:
        self.left, self.code, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.left:
                if self.low <= b <= self.high:
                    self.code = self.code << 6 | b & 0x3F
                    self.left -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.left:
                        out.append(chr(self.code))
                    continue
                out.append("�")
                self.left, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.left, self.code = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.left, self.code = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.left, self.code = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        cut, self.left, self.low, self.high = bool(self.left), 0, 0x80, 0xBF
        return "�" if cut else ""


class Tokenizer:
    """Text to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.machine = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.words: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; none for null and empty texts."""
        out: list[int] = []
        if not text:
            return out
        words = self.words
        for word in self.pattern.findall(text):
            ids = words.get(word)
            if ids is None:
                ids = self.machine.encode(word.encode("utf-8", "surrogatepass"))
                if len(words) >= REMEMBERED:
                    words.clear()
                if len(word) <= 64:
                    words[word] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``, made as they come; a character may be spread over many of them."""
        utf8 = Utf8()
        return "".join([utf8.feed(self.machine.tokens[i]) for i in ids]) + utf8.end()


_LOADED: dict[int, Tokenizer] = {}


def load(data: bytes) -> Tokenizer:
    """The tokenizer of a vocabulary, made once per worker."""
    key = hash(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(read_ranks(data))
    return _LOADED[key]


def with_ids(rows: DataFrame, text: str, keep: list[str], ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """Columns ``keep`` of ``rows`` and ``ids`` array<int>, the token ids of the string column ``text``.

    No special tokens: their strings are ordinary text. Null and empty texts have the empty list. Rows
    stay in number and place; nothing is shuffled. The vocabulary's file (under 1 MB) goes to the workers
    by broadcast.
    """
    spark = rows.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    narrow = rows.select(*keep, rows[text].cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(shared.value)
        for batch in batches:
            lists = [tokenizer.encode(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            values = np.fromiter((i for one in lists for i in one), np.int32, int(sizes.sum()))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*keep, ids])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1]), f"`{ids}` array<int>"])
    return narrow.mapInArrow(run, schema)
