"""Pre-tokenisation of whole texts for the word-level BPE vocabulary, over code-point arrays.

The vocabulary file asks for: split off the special tokens, NFC, white space to blanks, lower case, then
the pieces ``'s 't 're 've 'm 'll 'd``, runs of letters, single digits, and runs of other characters.
Texts whose characters all lie below U+0300 (no combining marks) take the array path: one lower-casing, one
class lookup and a few comparisons for a slice of documents.  Any other text takes the same rules through
a regular expression.  Words are numbered by a 64-bit polynomial hash of their code points in a table that
each Python worker keeps (at most ``MAX_WORDS``), so a word is only encoded when it is new to the table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import regex

MAX_WORDS = 300_000
_SIMPLE = 0x300
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the pre-tokeniser's pattern of the vocabulary file, with white space spelt out.
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACES}\p{{L}}\p{{N}}]+")
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _classes() -> np.ndarray:
    """0 space, 1 letter, 2 number, 3 other for each simple code point."""
    out = np.full(_SIMPLE, 3, np.uint8)
    for c in range(_SIMPLE):
        kind = unicodedata.category(chr(c))[0]
        if c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0):
            out[c] = 0
        elif kind in "LN":
            out[c] = 1 if kind == "L" else 2
    return out


_CLASS = _classes()


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit value of each code point."""
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the hash base and of its inverse, as long as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE_INVERSE)]), dtype=np.uint64)


_POWERS = _Powers()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span of 64-bit values, independent of the span's place."""
    _POWERS.upto(len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * _POWERS.up[:len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * _POWERS.down[starts]


def word_hashes(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(mix(cps), starts, ends)


def simple_words(lowered: str, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a lower-case text without code points from U+0300 on."""
    if not len(cps):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _CLASS[cps]
    cut = np.ones(len(cps) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    if "'" in lowered:
        starts, ends = _contractions(lowered, cps, starts, ends)
    return starts, ends


def _contractions(text: str, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An apostrophe alone before letters takes the letters of a contraction with it."""
    starts, ends = starts.copy(), ends.copy()
    gone = []
    for k in np.flatnonzero((cps[starts] == 0x27) & (ends - starts == 1)).tolist():
        at = int(starts[k]) + 1
        found = next((c for c in _CONTRACTIONS if text.startswith(c, at)), None)
        if found is None:
            continue
        ends[k] = at + len(found)
        starts[k + 1] = at + len(found)
        if starts[k + 1] == ends[k + 1]:
            gone.append(k + 1)
    return (np.delete(starts, gone), np.delete(ends, gone)) if gone else (starts, ends)


class Words:
    """Numbers of words, and what ``encode`` makes of each: ids in one array, cut by ``first``.

    ``encode`` takes the new words (lower-case, as code points) and returns a list of id lists.
    Numbers below ``len(specials)`` are the special tokens, in the file's order.
    """

    def __init__(self, specials: list[tuple[str, int]], encode: Callable[[list[str]], list]):
        self.specials, self._encode = specials, encode
        self._split = regex.compile("|".join(regex.escape(s) for s, _ in specials)) if specials else None
        self.clear()

    def clear(self) -> None:
        self._numbers: dict[int, int] = {}
        self.ids: list[list[int]] = [[i] for _, i in self.specials]

    def _lookup(self, text: str, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        codes, keys = pd.factorize(word_hashes(cps, starts, ends))
        first = np.empty(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        known = self._numbers
        keys = keys.tolist()
        numbers = [known.get(k, -1) for k in keys]
        new = [i for i, n in enumerate(numbers) if n < 0]
        if new:
            at = first[new]
            self.ids += self._encode([text[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            number = len(self.ids) - len(new)
            for i in new:
                numbers[i] = known[keys[i]] = number
                number += 1
        return np.array(numbers, np.int64)[codes] if len(codes) else np.zeros(0, np.int64)

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """Word numbers of each text.  Call ``clear`` only between calls."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            t = t or ""
            if t.isascii() or max(t) < "\u0300" and "\u0130" not in t:
                if "<|" in t and self._split is not None and self._split.search(t):
                    out[i] = self._slow(t)
                else:
                    plain.append(i)
            else:
                out[i] = self._slow(t)
        if plain:
            low = [(texts[i] or "").lower() for i in plain]
            joined = "\n".join(low)
            cps = code_points(joined)
            starts, ends = simple_words(joined, cps)
            found = self._lookup(joined, cps, starts, ends)
            stops = np.cumsum([len(t) + 1 for t in low])
            for i, part in zip(plain, np.split(found, np.searchsorted(starts, stops[:-1]))):
                out[i] = part
        return out

    def _slow(self, text: str) -> np.ndarray:
        words: list[str | int] = []
        names = {s: n for n, (s, _) in enumerate(self.specials)}
        at = 0
        for m in (self._split.finditer(text) if self._split else ()):
            words += _pieces(text[at:m.start()])
            words.append(names[m.group()])
            at = m.end()
        words += _pieces(text[at:])
        plain = [w for w in words if isinstance(w, str)]
        joined = "".join(plain)
        ends = np.cumsum([len(w) for w in plain], dtype=np.int64)
        starts = ends - np.array([len(w) for w in plain], np.int64)
        found = iter(self._lookup(joined, code_points(joined), starts, ends).tolist())
        return np.array([w if isinstance(w, int) else next(found) for w in words], np.int64)


def _pieces(text: str) -> list[str]:
    text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
    return _PIECES.findall(text)
