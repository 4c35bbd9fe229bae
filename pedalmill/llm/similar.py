"""How alike two spellings of a word are."""

from __future__ import annotations

#: Jaro-Winkler similarity from which on two different spellings of a word may be the same.
SIMILAR = 0.7


#: Letters up to which words are compared as a whole; of longer ones only what differs is.
LONG = 25


def rests(a: str, b: str) -> tuple[str, str]:
    """``a`` and ``b`` without the beginning and the end that they share."""
    i, most = 0, min(len(a), len(b))
    while i < most and a[i] == b[i]:
        i += 1
    j = 0
    while j < most - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return a[i : len(a) - j], b[i : len(b) - j]


def one_edit(a: str, b: str) -> bool:
    """Is one letter more, less, another, or swapped with its neighbour, all that they differ in? In linear time."""
    if abs(len(a) - len(b)) > 1:
        return False
    x, y = rests(a, b)
    return (len(x), len(y)) in ((0, 1), (1, 0), (1, 1)) or (len(x) == len(y) == 2 and x == y[::-1])


def likeness(a: str, b: str) -> float:
    """Jaro-Winkler similarity; of long words the share of letters that what differs leaves."""
    if max(len(a), len(b)) <= LONG:
        return jaro_winkler(a, b)
    x, y = rests(a, b)
    return 1.0 - max(len(x), len(y)) / max(len(a), len(b))


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    left: list[str] = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    right = [c for j, c in enumerate(b) if used[j]]
    m = len(left)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
    return jaro + min(prefix, 4) * 0.1 * (1 - jaro)


def lost_letters(typed: str, word: str) -> int:
    """Letters in which ``typed`` differs from ``word`` of the same length, ``?`` standing for any."""
    if len(typed) != len(word):
        return len(word) + 1
    return sum(a != b and a != "?" for a, b in zip(typed, word, strict=True))
