"""A true edit metric and a tree that searches by it."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable


def plain(text: str) -> str:
    """Lower case, without accents, đ as d; marks other than letters stay."""
    low = unicodedata.normalize("NFD", text.lower())
    return "".join(c for c in low if not unicodedata.combining(c)).replace("đ", "d")


def damerau(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance: the fewest insertions, deletions, substitutions and
    swaps of neighbours, where parts may be edited again. Unlike the restricted form it keeps the triangle
    inequality, which the tree's pruning needs."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    far = len(a) + len(b)
    rows = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    seen: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        row = [far, i]
        same = 0
        for j, y in enumerate(b, 1):
            k, m = seen.get(y, 0), same
            cost = 1
            if x == y:
                cost, same = 0, j
            row.append(
                min(
                    rows[i][j] + cost,
                    row[j] + 1,
                    rows[i][j + 1] + 1,
                    rows[k][m] + (i - k - 1) + 1 + (j - m - 1),
                )
            )
        rows.append(row)
        seen[x] = i
    return rows[-1][-1]


class BKTree:
    """Words by their distance from each other; search returns every word within a threshold."""

    def __init__(self, words: Iterable[str] = ()) -> None:
        self.root: tuple[str, dict] | None = None
        for word in words:
            self.add(word)

    def add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        node = self.root
        while True:
            d = damerau(word, node[0])
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = (word, {})
                return
            node = child

    def search(self, word: str, most: int) -> list[tuple[int, str]]:
        """(distance, entry) of every entry within ``most``, nearest first, then by entry."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            entry, children = todo.pop()
            d = damerau(word, entry)
            if d <= most:
                found.append((d, entry))
            todo += [child for e, child in children.items() if d - most <= e <= d + most]
        return sorted(found)
