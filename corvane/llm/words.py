"""Words of a text: A-Z lower-cased, runs of 0-9, a-z and everything beyond ASCII."""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np

_KEPT = [c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)]
_TABLE = bytes(_KEPT)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normalised(text: str | None) -> str:
    """`` w1 w2 ... wn `` with one space around each word; empty if there is no word."""
    joined = b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split())
    return f" {joined.decode('utf-8', 'surrogatepass')} " if joined else ""


def word_count(norm: str) -> int:
    return norm.count(" ") - 1 if norm else 0


def space_places(norm: str) -> np.ndarray:
    """Places of the spaces; the k-th word (from 0) stands between the k-th and the next."""
    return np.flatnonzero(np.frombuffer(norm.encode("utf-32-le", "surrogatepass"), "<u4") == 32)


def original_spans(text: str, words: list[int]) -> list[tuple[int, int]]:
    """Code-point spans in the original text of the words with these numbers (sorted)."""
    out, wanted = [], 0
    for k, m in enumerate(WORD.finditer(text)):
        if wanted == len(words):
            break
        if k == words[wanted]:
            out.append(m.span())
            wanted += 1
    return out


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint intervals [a, b) that cover the same."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def word_at(spaces: np.ndarray, place: int) -> int:
    """Number of the word that ends before the space at ``place``."""
    return bisect_left(spaces, place) - 1
