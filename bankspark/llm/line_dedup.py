"""Near-duplicate lines across documents by an exact set-similarity join.

A line is the set of its words (blank-separated, A to Z lower-cased).  It is removed if a line that comes
earlier (smaller doc_id, or same document and smaller line number) has Jaccard similarity of ``PERCENT``
or more; lines are judged on the input, not on what is left.

1. Each line becomes a set: size, 64-bit sum and 64-bit parity bitmap of its words (together its key).
2. The words of a set are dealt over parts by their hash, as many as its size band needs.  Similar sets differ in few
   words, so in few parts: of both, the first parts in a common order have one that is equal (``part_keys``).  Only those
   are dealt out, by their hash, packed by task; sets too small to have a similar one that is not equal are not.  Whole
   sets are dealt out too, which finds equal ones.  In a group equal sets are one; a group of very many sets is split:
   its sets fall in blocks, and each pair of blocks is a group of its own.
3. Within a group, pairs must pass the length filter and the bitmap filter (bits that differ are words that differ),
   its bits more for larger sets.  None of the filters drops a pair that is similar enough.
4. The texts of the lines in question are read again and Jaccard similarities verified: first of each line with its
   earliest candidate in each group, then with the next few.  Groups in which a line has further candidates are kept.
   There, lines that are still open are held against all earlier ones, group by group: the lines' texts are dealt out by
   group, a row for each line, and no pairs are listed; groups of more than ``GROUP`` words in blocks.  A group's pairs are
   all walked, but a task holds about ``PAIRS`` of them at once.
5. A line goes if it is a later copy of a set, or the first line of a set with an earlier similar line.

Defined cases: a line without words is never removed; null text is one empty line; repeated rows of a
document share line numbers and do not remove each other; rows without doc_id come last, in an order of their
texts' hashes (ids must be below 2^62), and those of equal texts count as repeated rows; an empty table
gives an empty result; further columns are ignored by ``line_duplicates`` and kept by ``drop_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import binary_array, column, slices, text_bytes
from bankspark.llm.shingles import byte_values, word_spans
from bankspark.llm.words import mix, span_hashes
from bankspark.session import written

PERCENT = 80
RANGE = 1 << 14        # bits of a filter that travel together
CHUNK = 1 << 21        # words that a task collects before it deals them out
SPARE = 1.5            # parts of a set for each that it must give
SPLIT = 20_000         # sets that a word's group may hold before it is split
FILTER = 1 << 20       # slots of the filters that save reading lines again, at first
MOST = 1 << 27         # bits that such a filter may grow to, 8 for each pair
NEAREST = 3            # candidates of a line and group that are looked at before all of them
PAIRS = 1 << 20        # pairs of a word's group that a task holds at once
BODIES = 2_000         # pairs whose lines are compared at once
GROUP = 1 << 21        # words of the lines that are held against each other at once
NARROW = 32            # words from which on sets have bitmaps of 64 bits; smaller ones have them folded to 32
WIDE = 96              # words of sets that have bitmaps of 128 bits
_PART, _WHOLE, _COPY, _OPEN = range(4)  # kinds of packed rows
_KEYS = (3, 8, 1, 3)   # bytes of their keys
_CODEC = pa.Codec("zstd", compression_level=1)
_ENDS = ["doc_id", "line", "doc_2", "line_2"]
_ENDS_TYPES = "doc_id long, line int, doc_2 long, line_2 int"
_PACKED = ["part", "kind", "first_doc", "key", "step", "at", "n", "h", "narrow", "b", "wide"]
_PACKED_TYPES = "part int, kind int, first_doc long, " + ", ".join(f"{x} binary" for x in _PACKED[3:])
_FOUND = dict(zip(_ENDS + ["first", "more"] + _PACKED, 2 * [pa.int64(), pa.int32()] + 2 * [pa.bool_()] + 2 * [pa.int32()]
                  + [pa.int64()] + 8 * [pa.binary()]))
_LAST = 1 << 62        # from here on are the places of rows without doc_id in the order of lines


def line_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, bytes of the words, words before each line and in all, lines before each text and in all).

    Each line's words are distinct and in the order of their hashes.
    """
    data, offsets = text_bytes(texts)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    breaks = np.flatnonzero(data == 10)
    lines = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    lines[-1:] = len(breaks) + len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    words = mix(span_hashes(byte_values(data), starts, ends))
    line = np.searchsorted(breaks, starts) + np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    order = None
    if len(words) and lines[-1] < 1 << 20:
        key = line.astype(np.uint64) << np.uint64(44) | words >> np.uint64(20)
        order = np.argsort(key)
        key, sorted_words = key[order], words[order]
        if ((key[1:] == key[:-1]) & (sorted_words[1:] != sorted_words[:-1])).any():
            order = None  # two words of a line share the key's bits
    if order is None:
        order = np.lexsort((words, line))
    words, line, length = words[order], line[order], (ends - starts)[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
    words, line = words[new], line[new]
    return words, length[new], np.searchsorted(line, np.arange(lines[-1] + 1)), lines


def set_keys(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sum, parity bitmap, size) of each line's set."""
    size = np.diff(first)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(words ^ np.uint64(0xABCDEF)))])
    bits = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(np.uint64(1) << (mix(words) & np.uint64(63)))])
    return sums[first[1:]] - sums[first[:-1]], bits[first[1:]] ^ bits[first[:-1]], size


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + count[0] - 1, first[1] ..., in one array."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _lines_of(batch: pa.RecordBatch, i: int, j: int):
    """(words, their bytes, first, doc_id, line) of the texts i to j of a batch."""
    words, length, first, lines = line_words(column(batch, "text").slice(i, j - i))
    count = np.diff(lines)
    doc = np.repeat(column(batch, "doc_id").slice(i, j - i).to_numpy(zero_copy_only=False), count)
    return words, length, first, doc, np.arange(lines[-1]) - np.repeat(lines[:-1], count)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """What ``_lines_of`` gives, for about ``CHUNK`` words at a time."""
    held, size = [], 0
    for batch in batches:
        for i, j in slices(text_bytes(column(batch, "text"))[1]):
            held.append(_lines_of(batch, i, j))
            size += len(held[-1][0])
            if size >= CHUNK:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    words, length, first, doc, line = zip(*held)
    before = np.cumsum([0, *map(len, words)])
    first = np.concatenate([f[:-1] + at for f, at in zip(first, before)] + [before[-1:]])
    return np.concatenate(words), np.concatenate(length), first, np.concatenate(doc), np.concatenate(line)


def _earliest(h: np.ndarray, b: np.ndarray, doc: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of an earliest line of each set, and of the lines that are later copies of a set."""
    order = np.lexsort((line, doc, b, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (b[order][1:] != b[order][:-1])
    at = order[new]
    its = at[np.cumsum(new) - 1]
    late = (doc[order] != doc[its]) | (line[order] != line[its])
    return at, order[late]


def line_slots(doc: np.ndarray, line: np.ndarray, size: int = FILTER) -> np.ndarray:
    return (mix(mix(doc) + line.astype(np.uint64)) % np.uint64(size)).astype(np.int64)


def most_different(small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
    """Words that similar sets of these sizes may differ in: those of one alone and those of the other alone."""
    return (100 - percent) * (small + large) // (100 + percent)


def part_keys(words: np.ndarray, length: np.ndarray, first: np.ndarray, sets: np.ndarray,
              percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key of a part of its words) such that any two similar sets have a key in common.

    For each size band [2^i, 2^(i+1)) words are dealt over k parts by their hash, and a set gives the parts for its own
    band and, if a similar set can be that large, for the next.  Similar sets differ in d words at most, so in d parts;
    of both, the first d + 1 parts in any common order have one that is equal.  Parts with the most bytes come first.
    """
    n = np.diff(first)
    mixed = np.concatenate([[np.uint64(0)], np.cumsum(mix(words ^ np.uint64(0x1234567)))])
    owners, keys = [], []
    for step in (0, 1):
        low = np.left_shift(1, np.floor(np.log2(n[sets])).astype(np.int64) + step)
        most = 100 * n[sets] // percent  # words of the largest similar set
        here = sets[most >= low]
        low, most = low[most >= low], most[most >= low]
        k = np.ceil(SPARE * (most_different(2 * low - 1, 2 * low - 1, percent) + 1)).astype(np.int64)
        reach = most_different(n[here], np.minimum(most, 2 * low - 1), percent) + 1
        at = _spread(first[here], n[here])
        base = np.cumsum(k) - k
        part = (words[at] >> np.uint64(32)) * np.repeat(k, n[here]).astype(np.uint64) >> np.uint64(32)
        part = part.astype(np.int64) + np.repeat(base, n[here])  # ascending, as words of a line are
        total = int(k.sum())
        cut = np.searchsorted(part, np.arange(total + 1))
        ends = np.append(at, 0)
        some = cut[1:] > cut[:-1]
        value = np.zeros(total, np.uint64)
        value[some] = mixed[ends[cut[1:][some] - 1] + 1] - mixed[ends[cut[:-1][some]]]
        weight = np.bincount(part, length[at], total)
        owner = np.repeat(np.arange(len(here)), k)
        number = (np.arange(total) - base[owner]).astype(np.uint64)
        value = mix(value + mix(number * np.uint64(1 << 32) + np.repeat(low, k).astype(np.uint64)))
        rank = (owner.astype(np.uint64) << np.uint64(40)) | ((np.uint64(65535) - np.minimum(weight, 65535).astype(np.uint64))
                                                            << np.uint64(24)) | (value >> np.uint64(40))
        order = np.argsort(rank)
        if (rank[order][1:] == rank[order][:-1]).any():  # two parts share the rank's bits: their order must not depend on the set
            order = np.lexsort((value, rank))
        hit = order[np.arange(total) - base[owner] < reach[owner]]
        owners.append(here[owner[hit]])
        keys.append(value[hit])
    return np.concatenate(owners), np.concatenate(keys)


def _postings(source: DataFrame, counts: np.ndarray, percent: int, slots: np.ndarray | None = None) -> DataFrame:
    """(word, doc_id, line, b, n, place) of the prefix words of each set, by its earliest line in the task; a split word
    once per pair of its blocks.  Only words whose slots are marked, if given."""
    rarity = np.minimum(8 * np.log2(counts + 1), 255).astype(np.uint8)
    least = percent // (100 - percent)  # words of the smallest set that is similar to another
    blocks = np.minimum(np.maximum(1, -(-counts // SPLIT)), 1 << 15).astype(np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            for i, j in slices(text_bytes(column(batch, "text"))[1]):
                words, first, doc, line, _ = _lines_of(batch, i, j, rarity)
                h, b, n = set_keys(words, first)
                new = seen.new(h ^ b, np.where(n >= least, n, 0), doc, line)
                if not len(new):
                    continue
                reach = n[new] - -(-percent * n[new] // 100) + 1
                at = _spread(first[new], reach)
                owner = np.repeat(new, reach)
                slot = (words[at] % np.uint64(SLOTS)).astype(np.int64)
                hit = counts[slot] > 1  # else no other set holds the word
                if slots is not None:
                    hit &= slots[slot]
                at, owner = at[hit], owner[hit]
                word, place = words[at], at - first[owner]
                k = blocks[(word % np.uint64(SLOTS)).astype(np.int64)].astype(np.int64)
                many = np.repeat(np.arange(len(at)), k)
                other = (np.arange(len(many)) - np.repeat(np.cumsum(k) - k, k)).astype(np.uint64)
                word, place, owner, k = word[many], place[many], owner[many], k[many].astype(np.uint64)
                block = h[owner] % k
                low, high = np.minimum(block, other), np.maximum(block, other)
                word = np.where(k > 1, mix(word + mix(low * np.uint64(1 << 32) + high)), word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.view(np.int64)), pa.array(doc[owner]), pa.array(line[owner].astype(np.int32)),
                     pa.array(b[owner].view(np.int64)), pa.array(n[owner].astype(np.int32)),
                     pa.array(place.astype(np.int32))], ["word", "doc_id", "line", "b", "n", "place"])

    return source.mapInArrow(run, "word long, doc_id long, line int, b long, n int, place int")


def _prefix_slots(source: DataFrame, counts: np.ndarray, percent: int, lines: np.ndarray) -> np.ndarray:
    """Filter of SLOTS slots with those of the marked lines' prefix words set."""
    rarity = np.minimum(8 * np.log2(counts + 1), 255).astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(text_bytes(column(batch, "text"))[1]):
                words, first, doc, line, _ = _lines_of(batch, i, j, rarity)
                n = np.diff(first)
                some = np.flatnonzero((n > 0) & lines[line_slots(doc, line)])
                at = _spread(first[some], n[some] - -(-percent * n[some] // 100) + 1)
                slot = np.unique((words[at] % np.uint64(SLOTS)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(slot)], ["slot"])

    out = np.zeros(SLOTS, bool)
    out[source.mapInArrow(run, "slot long").distinct().toPandas()["slot"].to_numpy(np.int64)] = True
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    """The values in as few bytes as hold all of them."""
    for kind in (np.uint8, np.uint16, np.int32):
        if not len(x) or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return x.astype(kind)
    return x.astype(np.int64)


def _squeezed(x: np.ndarray) -> bytes:
    """The values in few bytes: their size, then first bytes, second bytes and so on, compressed if that makes them fewer."""
    x = _narrow(x)
    data = x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    small = _CODEC.compress(data, asbytes=True)
    return bytes([x.itemsize + 16]) + small if len(small) < len(data) else bytes([x.itemsize]) + data


def _unsqueezed(data: bytes, count: int) -> np.ndarray:
    size, data = data[0] & 15, data[1:] if data[0] < 16 else _CODEC.decompress(data[1:], count * (data[0] & 15))
    planes = np.frombuffer(data, np.uint8).reshape(size, count)
    return np.ascontiguousarray(planes.T).reshape(-1).view({1: np.uint8, 2: np.uint16, 4: np.int32, 8: np.int64}[size])


def _folded(b: np.ndarray) -> np.ndarray:
    """64-bit parity bitmaps folded to 32 bits; those that are folded stay as they are."""
    return (b ^ (b >> np.uint64(32))) & np.uint64(0xFFFFFFFF)


def _packed(kind: int, part: np.ndarray, key: np.ndarray, doc: np.ndarray, line: np.ndarray, b: np.ndarray,
            n: np.ndarray, h: np.ndarray, wide: np.ndarray) -> pa.RecordBatch:
    """A row per part, with its rows' values as bytes; doc as differences, each set's bitmap in the bits for its size."""
    order = np.argsort(part, kind="stable")
    part, doc, line, n, b = part[order], doc[order], line[order], n[order], b[order].astype(np.uint64)
    cut = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    step = np.diff(doc, prepend=0)
    step[cut] = 0
    ends = np.append(cut, len(part))
    small = [pa.array([_squeezed(x[i:j]) for i, j in zip(ends[:-1], ends[1:])], pa.binary()) for x in (step, line, n)]
    keys = key[order].astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :_KEYS[kind]]
    bits = []
    for some, x in ((n < NARROW, _folded(b).astype(np.uint32)), ((n >= NARROW) & (n < WIDE), b), (n >= WIDE, wide[order])):
        x = x[some].reshape(-1).view(np.uint8)
        before = np.append(0, np.cumsum(some))[ends]
        bits.append(binary_array(x, before * (len(x) // max(int(before[-1]), 1))))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cut].astype(np.int32)), pa.array(np.full(len(cut), kind, np.int32)), pa.array(doc[cut]),
         binary_array(keys.reshape(-1), ends * _KEYS[kind]), *small,
         binary_array(h[order].astype(np.uint32).view(np.uint8), ends * 4), *bits], _PACKED)


def _unpacked(rows: list[dict]) -> list[np.ndarray]:
    """(key, doc, line, b, n, h, wide) of packed rows of one part and kind."""
    out: list[list[np.ndarray]] = [[] for _ in range(7)]
    for r in rows:
        size = _KEYS[r["kind"]]
        count = len(r["key"]) // size
        key = np.zeros((count, 8), np.uint8)
        key[:, :size] = np.frombuffer(r["key"], np.uint8).reshape(count, size)
        step, line, n = (_unsqueezed(r[x], count).astype(np.int64) for x in ("step", "at", "n"))
        wide = np.zeros((count, 2), np.uint64)
        wide[n >= WIDE] = np.frombuffer(r["wide"], np.uint64).reshape(-1, 2)
        b = wide[:, 0] ^ wide[:, 1]
        b[n < NARROW] = np.frombuffer(r["narrow"], np.uint32)
        b[(n >= NARROW) & (n < WIDE)] = np.frombuffer(r["b"], np.uint64)
        for x, y in zip(out, (key.reshape(-1).view(np.uint64), r["first_doc"] + np.cumsum(step), line.astype(np.int32), b,
                              n.astype(np.int32), np.frombuffer(r["h"], np.uint32), wide)):
            x.append(y)
    return [np.concatenate(x) for x in out]


def wide_bitmaps(words: np.ndarray, first: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """Two 64-bit parity bitmaps of each set, each of the words of one half of the hashes: ``set_keys`` has their sum."""
    at = _spread(first[sets], np.diff(first)[sets])
    mixed = mix(words[at])
    bit, half = np.uint64(1) << (mixed & np.uint64(63)), (mixed >> np.uint64(6)) & np.uint64(1)
    ends = np.append(0, np.cumsum(np.diff(first)[sets]))
    out = np.zeros((len(sets), 2), np.uint64)
    for k in (0, 1):
        bits = np.append(np.uint64(0), np.bitwise_xor.accumulate(np.where(half == k, bit, np.uint64(0))))
        out[:, k] = bits[ends[1:]] ^ bits[ends[:-1]]
    return out


def _dealt(source: DataFrame, percent: int, parts: int) -> DataFrame:
    """Packed rows: keys of the parts of each set, by its earliest line in a chunk; whole sets; later copies in a chunk."""
    least = percent // (100 - percent)  # words of the smallest set that is similar to another

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, length, first, doc, line in _chunks(batches):
            h, b, n = set_keys(words, first)
            some = np.flatnonzero(n)
            one, late = (some[np.sort(x)] for x in _earliest(h[some], b[some], doc[some], line[some]))
            none = np.zeros(len(n), np.int64)
            wide = np.zeros((len(n), 2), np.uint64)
            yield _packed(_WHOLE, h[one] % np.uint64(parts), h[one], doc[one], line[one], b[one], none[one], none[one],
                          wide[one])
            at = np.full(len(late), int(mix(doc[late[:1]]).sum() % np.uint64(parts)), np.uint64)
            yield _packed(_COPY, at, none[late].astype(np.uint8), doc[late], line[late], none[late], none[late], none[late],
                          wide[late])
            one = one[n[one] >= least]
            large = one[n[one] >= WIDE]
            wide[large] = wide_bitmaps(words, first, large)
            owner, key = part_keys(words, length, first, one, percent)
            order = np.argsort(owner, kind="stable")
            owner, key = owner[order], key[order]
            yield _packed(_PART, (key >> np.uint64(32)) % np.uint64(parts), key.astype(np.uint32), doc[owner], line[owner],
                          b[owner], n[owner], h[owner], wide[owner])

    return source.mapInArrow(run, _PACKED_TYPES)


def candidate_pairs(word: np.ndarray, b: np.ndarray, n: np.ndarray, place: np.ndarray,
                    percent: int, wide: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of one word that may be similar, from rows sorted by (word, n); runs of a word are walked by distance.
    They come in slices of less than ``PAIRS`` pairs and one for each row."""
    left, right, held = [], [], 0
    distance, i = 1, np.arange(len(word) - 1)
    while len(i):
        i = i[i + distance < len(word)]
        j = i + distance
        # length filter: the sets of a word come in the order of their size
        near = (word[i] == word[j]) & (100 * n[i] >= percent * n[j])
        i, j = i[near], j[near]
        both = n[i] + n[j]
        need = -(-percent * both // (100 + percent))
        good = np.minimum(n[i] - place[i], n[j] - place[j]) >= need
        x, y = i[good], j[good]
        most = both[good] - 2 * need[good]
        bits = b[x] ^ b[y]
        odd = (n[x] < NARROW) & (n[y] >= NARROW)
        if odd.any():
            bits[odd] = _folded(bits[odd])
        good = np.bitwise_count(bits) <= most
        if wide is not None:
            some = np.flatnonzero(good & (n[x] >= WIDE) & (n[y] >= WIDE))
            good[some] = np.bitwise_count(wide[x[some]] ^ wide[y[some]]).sum(axis=1) <= most[some]
        left.append(x[good])
        right.append(y[good])
        held += len(left[-1])
        if held >= PAIRS:
            yield np.concatenate(left), np.concatenate(right)
            left, right, held = [], [], 0
        distance += 1
    if held:
        yield np.concatenate(left), np.concatenate(right)


class _Nearest:
    """The ``NEAREST`` earliest candidates of each row, and their number, from slices of pairs."""

    def __init__(self, rows: int) -> None:
        self.best = np.full((rows, NEAREST), rows)  # ranks of candidates; ``rows`` stands for none
        self.count = np.zeros(rows, np.int64)

    def add(self, i: np.ndarray, rank: np.ndarray) -> None:
        """Takes a slice of pairs: rows and the ranks of their candidates."""
        none = len(self.best)
        self.count += np.bincount(i, minlength=none)
        early = rank < self.best[i, -1]
        i, rank = np.divmod(np.sort(i[early] * none + rank[early]), none)
        rows, begin, count = np.unique(i, return_index=True, return_counts=True)
        at = np.arange(len(i)) - np.repeat(begin, count)
        hit = at < NEAREST
        new = np.full((len(rows), NEAREST), none)
        new[np.repeat(np.arange(len(rows)), count)[hit], at[hit]] = rank[hit]
        self.best[rows] = np.sort(np.concatenate([self.best[rows], new], axis=1), axis=1)[:, :NEAREST]


def _ranks(doc: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each row's line in the order of lines, rows of one line sharing it, and a row of each place."""
    order = np.lexsort((line, doc))
    new = np.ones(len(order), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (line[order][1:] != line[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order[new]


def group_candidates(table: list[np.ndarray], percent: int, lines: np.ndarray | None = None,
                     wide: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of ``_found`` from whole groups (word, doc_id, line, b, n, place), sorted by (word, n)."""
    names = ["doc_id", "line", "doc_2", "line_2", "first", "more"]
    word, doc, line, b, n, place = table
    rank, row = _ranks(doc, line)
    nearest = _Nearest(len(word))
    for i, j in candidate_pairs(word, b.view(np.uint64), n.astype(np.int64), place.astype(np.int64), percent,
                                wide):
        apart = rank[i] != rank[j]
        i, j = i[apart], j[apart]
        later = rank[i] > rank[j]
        i, j = np.where(later, i, j), np.where(later, j, i)
        if lines is None:
            nearest.add(i, rank[j])
            continue
        hit = lines[line_slots(doc[i], line[i])]
        i, j = i[hit], j[hit]
        no = np.zeros(len(i), bool)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[i], line[i], doc[j], line[j], no, no)], names)
    if lines is None:
        i, at = np.nonzero(nearest.best < len(word))
        j = row[nearest.best[i, at]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (doc[i], line[i], doc[j], line[j], at == 0, nearest.count[i] > NEAREST)], names)


def _pairs(postings: DataFrame, percent: int, lines: np.ndarray | None = None) -> DataFrame:
    """Candidate pairs (doc_id, line, doc_2, line_2): a line and an earlier one, up to ``NEAREST`` of a group, the earliest
    of it marked as ``first``; ``more`` if the group has further ones.  With ``lines``, all candidates of the marked lines."""
    names = ["word", "doc_id", "line", "b", "n", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [column(batch, x).to_numpy(zero_copy_only=False) for x in names]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last word may go on
            if cut:
                yield from group_candidates([x[:cut] for x in held], percent, lines)
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield from group_candidates(held, percent, lines)

    return (postings.repartition("word").sortWithinPartitions("word", "n")
            .mapInArrow(run, "doc_id long, line int, doc_2 long, line_2 int, first boolean, more boolean"))


def _split_group(key: np.ndarray, size: np.ndarray, doc: np.ndarray, line: np.ndarray, split: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the sets of a large group fall in blocks, and each pair of blocks is a group of its own."""
    k = -(-size // split)
    row = np.repeat(np.arange(len(key)), k)
    other = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
    block = (mix(mix(doc) + line.astype(np.uint64)) % k.astype(np.uint64)).astype(np.int64)[row]
    low, high = np.minimum(block, other), np.maximum(block, other)
    return row, mix(mix(key[row]) + (low * (1 << 32) + high).astype(np.uint64))


def _with_nulls(columns: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    """Batch of ``_found``: the named columns, null in the others."""
    have, size = dict(zip(names, columns)), len(columns[0])
    return pa.RecordBatch.from_arrays([have.get(x, pa.nulls(size, t)) for x, t in _FOUND.items()], list(_FOUND))


def _candidates(rows: list[dict], percent: int, parts: int, split: int | None) -> Iterator[pa.RecordBatch]:
    """Batches of ``_found`` from the packed rows of one part."""
    for kind in (_COPY, _WHOLE, _PART):
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        key, doc, line, b, n, h, wide = _unpacked(own)
        if kind != _PART:
            late = _earliest(key, b, doc, line)[1] if kind == _WHOLE else slice(None)
            yield _with_nulls([pa.array(doc[late]), pa.array(line[late])], ["doc_id", "line"])
            continue
        order = np.argsort(key)
        order = order[_group_sizes(key[order]) > 1]
        # equal sets are one in a group, by their earliest line
        order = order[np.lexsort((line[order], doc[order], h[order], b[order], n[order], key[order]))]
        new = np.ones(len(order), bool)
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (h, b, n, key)], axis=0)
        order = order[new]
        size = _group_sizes(key[order])
        order, size = order[size > 1], size[size > 1]
        if split is not None and (large := size > split).any():
            far, far_size = order[large], size[large]
            order, size = order[~large], size[~large]
            at, again = _split_group(key[far], far_size, doc[far], line[far], split)
            at = far[at]
            out = _packed(_PART, (again >> np.uint64(32)) % np.uint64(parts), again.astype(np.uint32), doc[at], line[at],
                          b[at], n[at], h[at], wide[at])
            yield _with_nulls(out.columns, _PACKED)
        table = [key[order].astype(np.int64), doc[order], line[order], b[order].view(np.int64), n[order],
                 np.zeros(len(order), np.int64)]
        more = []
        for out in group_candidates(table, percent, wide=wide[order]):
            yield _with_nulls(out.columns, out.schema.names)
            has = column(out, "more").to_numpy(zero_copy_only=False)
            more.append(np.unique(line_slots(column(out, "doc_id").to_numpy()[has], column(out, "line").to_numpy()[has])))
        far = order[_of_marked(key[order], np.isin(line_slots(doc[order], line[order]), np.concatenate([*more, []])))]
        if len(far):
            out = _packed(_OPEN, np.full(len(far), own[0]["part"]), key[far], doc[far], line[far], b[far], n[far], h[far],
                          wide[far])
            yield _with_nulls(out.columns, _PACKED)


def _group_sizes(key: np.ndarray) -> np.ndarray:
    """Rows of each row's group (run of a key)."""
    count = np.diff(np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)]), len(key)))
    return np.repeat(count, count)


def _of_marked(key: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Whether each row is of a group (run of a key) with a marked row."""
    if not len(key):
        return np.zeros(0, bool)
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))
    return (np.bincount(group, marked) > 0)[group]


def _found(dealt: DataFrame, percent: int, parts: int, split: int | None) -> DataFrame:
    """Candidate pairs (doc_id, line, doc_2, line_2): a line and an earlier one, up to ``NEAREST`` of a group, the earliest
    of it marked as ``first``; ``more`` if the group has further ones.  Also later copies of sets, without doc_2; the
    groups that have further ones, packed; and, if ``split`` is given, groups of more sets, split and packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield from _candidates(held, percent, parts, split)
                    held = []
                held.append(row)
        if held:
            yield from _candidates(held, percent, parts, split)

    return (dealt.repartition("part").sortWithinPartitions("part")
            .mapInArrow(run, f"{_ENDS_TYPES}, first boolean, more boolean, {_PACKED_TYPES}"))


def _pairs(source: DataFrame, percent: int) -> DataFrame:
    """All rows of ``_found`` but the split groups, written."""
    parts = 4 * int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(_found(_dealt(source, percent, parts), percent, parts, SPLIT), "pairs")
    large = rows.filter(F.col("kind") == _PART).select(*_PACKED)
    if large.isEmpty():
        return rows
    return rows.filter(F.coalesce("kind", F.lit(_OPEN)) == _OPEN).unionByName(
        written(_found(large, percent, parts, None), "pairs"))


def in_blocks(rank: np.ndarray, n: np.ndarray, marked: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, rows, open) of a group of sets of ``n`` words: blocks of its rows, in the order of ``rank``, and, for each, its
    marked rows with those of each block before it; a block has about half of ``most`` words."""
    order = np.argsort(rank, kind="stable")
    block = np.cumsum(n[order], dtype=np.int64) * 2 // most if n.sum() > most else np.zeros(len(order), np.int64)
    rows = np.split(order, np.flatnonzero(np.diff(block)) + 1)
    for high, own in enumerate(rows):
        late = own[marked[own]]
        if len(late):
            yield (high << 32) + high, own, marked[own]
            for low, early in enumerate(rows[:high]):
                yield (high << 32) + low, np.concatenate([early, late]), np.arange(len(early) + len(late)) >= len(early)


def _members(groups: DataFrame, percent: int, lines: np.ndarray, most: int) -> DataFrame:
    """(group, doc_id, line, open): the marked lines of packed groups and their candidates; groups of more than ``most``
    words in blocks, each pair of which is a group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key, doc, line, b, n, _, wide = _unpacked([row])
                marked = lines[line_slots(doc, line)]
                hit = np.flatnonzero(_of_marked(key, marked))
                key, doc, line, b, n, wide, marked = (x[hit] for x in (key, doc, line, b, n, wide, marked))
                rank = _ranks(doc, line)[0]
                some, none = np.zeros(len(key), bool), np.zeros(len(key), np.int64)
                for i, j in candidate_pairs(key, b, n.astype(np.int64), none, percent, wide):
                    own = (rank[i] != rank[j]) & marked[np.where(rank[i] > rank[j], i, j)]
                    some[i[own]] = some[j[own]] = True
                at = np.flatnonzero(some)
                out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)]
                for own in np.split(at, np.flatnonzero(np.diff(key[at])) + 1) if len(at) else []:
                    name = (row["part"] << 32) + int(key[own[0]])
                    for number, rows, late in in_blocks(rank[own], n[own], marked[own], most):
                        group = mix(mix(np.array([name])) + np.uint64(number)).view(np.int64)
                        out.append((np.repeat(group, len(rows)), own[rows], late))
                group, at, late = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (group, doc[at], line[at], late)],
                                                 ["group", "doc_id", "line", "open"])

    return groups.mapInArrow(run, "group long, doc_id long, line int, open boolean")


def similar_before(words: np.ndarray, first: np.ndarray, percent: int, wanted: np.ndarray) -> np.ndarray:
    """The wanted sets of which an earlier one is similar."""
    h, b, n = set_keys(words, first)
    large = np.flatnonzero(n >= WIDE)
    wide = np.zeros((len(n), 2), np.uint64)
    wide[large] = wide_bitmaps(words, first, large)
    names, number = np.unique(words, return_inverse=True)
    own = np.zeros(len(names), bool)
    found = []
    for i in wanted[n[wanted] > 0]:
        both = n[:i] + n[i]
        most = both - 2 * -(-percent * both // (100 + percent))
        near = np.flatnonzero((100 * np.minimum(n[:i], n[i]) >= percent * np.maximum(n[:i], n[i]))
                              & (np.bitwise_count(b[:i] ^ b[i]) <= most))
        if n[i] >= WIDE:
            near = near[(n[near] < WIDE) | (np.bitwise_count(wide[near] ^ wide[i]).sum(axis=1) <= most[near])]
        own[number[first[i]:first[i + 1]]] = True
        step = 16
        while len(near):  # the earliest first
            some, near, step = near[:step], near[step:], 2 * step
            common = np.add.reduceat(own[number[_spread(first[some], n[some])]], np.cumsum(n[some]) - n[some], dtype=np.int64)
            if (100 * common >= percent * (n[some] + n[i] - common)).any():
                found.append(i)
                break
        own[number[first[i]:first[i + 1]]] = False
    return np.array(found, np.int64)


def _similar_in_groups(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line) of the open lines that are similar to an earlier one of their group; no pairs are listed."""
    def of(rows: pa.Table) -> pa.RecordBatch:
        doc, line = (column(rows, x).to_numpy() for x in ("doc_id", "line"))
        rows = rows.filter(pa.array(np.append(True, (doc[1:] != doc[:-1]) | (line[1:] != line[:-1]))))  # a line once
        words, _, first, _ = line_words(column(rows, "body"))
        late = similar_before(words, first, percent, np.flatnonzero(column(rows, "open").to_numpy()))
        return pa.RecordBatch.from_arrays([column(rows, x).combine_chunks().take(pa.array(late)) for x in ("doc_id", "line")],
                                          ["doc_id", "line"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = column(batch, "group").to_numpy()
            cut = np.append(0, np.flatnonzero(np.diff(group)) + 1)[:len(group)]
            for i, j in zip(cut, np.append(cut[1:], len(group))):
                if held and column(held[0], "group")[0].as_py() != group[i]:
                    yield of(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(i, j - i))
        if held:
            yield of(pa.Table.from_batches(held))

    bodies = _once(texts).select(F.col("of_doc").alias("doc_id"), F.col("of_line").alias("line"), "body")
    return (members.join(bodies, ["doc_id", "line"]).repartition("group")
            .sortWithinPartitions("group", "doc_id", "line", F.desc("open"))
            .mapInArrow(run, "doc_id long, line int"))


def _marks(lines: DataFrame, size: int) -> np.ndarray:
    """Filter of ``size`` bits, packed, in which the slots of the lines (doc_id, line) are set; it comes in ranges."""
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, line = (column(b, n).to_numpy(zero_copy_only=False) for n in ("doc_id", "line"))
            slot = np.unique(line_slots(doc, line, size))
            yield pa.RecordBatch.from_arrays([pa.array((slot // RANGE).astype(np.int32)),
                                              pa.array((slot % RANGE).astype(np.int32))], ["range", "bit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for b in batches:
            at, bit = (column(b, n).to_numpy() for n in ("range", "bit"))
            order = np.argsort(at, kind="stable")
            for k, own in zip(*_groups(at[order], bit[order])):
                bits.setdefault(k, np.zeros(RANGE, bool))[own] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(bits), pa.int32()),
                                          pa.array([np.packbits(x).tobytes() for x in bits.values()], pa.binary())], ["range", "bits"])

    out = np.zeros((size // RANGE, RANGE // 8), np.uint8)
    rows = lines.mapInArrow(slots, "range int, bit int").repartition("range").mapInArrow(run, "range int, bits binary").toArrow()
    for at, data in zip(rows["range"].to_pylist(), rows["bits"].to_pylist()):
        out[at] = np.frombuffer(data, np.uint8)
    return out.reshape(-1)


def _groups(key: np.ndarray, value: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Keys and the values of each, from rows sorted by key."""
    cut = np.flatnonzero(key[1:] != key[:-1]) + 1
    return (key[np.append(0, cut)].tolist(), np.split(value, cut)) if len(key) else ([], [])


def _line_texts(source: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(of_doc, of_line, body): the bytes of at least the wanted lines (doc_id, line)."""
    marks = _marks(wanted, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = column(batch, "doc_id").to_numpy()
            data, offsets = text_bytes(column(batch, "text"))
            for i, j in slices(offsets):
                part, cuts = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                breaks = np.flatnonzero(part == 10)
                start = np.sort(np.concatenate([cuts[:-1], breaks + 1]), kind="stable")
                before = np.searchsorted(breaks, cuts[:-1]) + np.arange(j - i)
                text = np.repeat(np.arange(j - i), np.diff(np.append(before, len(start))))
                line = np.arange(len(start)) - before[text]
                stop = np.append(start[1:], len(part))
                last = np.append(text[1:] != text[:-1], True)
                stop = np.where(last, cuts[text + 1], stop - 1)
                slot = line_slots(names[i:j][text], line, size)
                hit = np.flatnonzero(marks[slot >> 3] << (slot & 7).astype(np.uint8) & 128)
                length = stop[hit] - start[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[i:j][text[hit]]), pa.array(line[hit].astype(np.int32)),
                     binary_array(part[_spread(start[hit], length)], np.concatenate([[0], np.cumsum(length)]))],
                    ["of_doc", "of_line", "body"])

    return source.mapInArrow(run, "of_doc long, of_line int, body binary")


def _texts_of(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """At least the texts of the wanted lines (doc_id, line)."""
    marks = _marks(wanted, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = line_slots(column(b, "of_doc").to_numpy(), column(b, "of_line").to_numpy(), size)
            yield b.filter(pa.array((marks[slot >> 3] << (slot & 7).astype(np.uint8) & 128) > 0))

    return texts.mapInArrow(run, texts.schema)


def common_words(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Words that the k-th sets (words, words before each and in all) have in common."""
    size = len(one[1]) - 1
    pair = np.concatenate([np.repeat(np.arange(size), np.diff(x)) for _, x in (one, two)])
    words = np.concatenate([one[0], two[0]])
    order = np.lexsort((words, pair))
    pair, words = pair[order], words[order]
    return np.bincount(pair[1:][(words[1:] == words[:-1]) & (pair[1:] == pair[:-1])], minlength=size)


def _once(texts: DataFrame) -> DataFrame:
    """Each line's text once: repeated rows of a document have the same lines."""
    return texts.dropDuplicates(["of_doc", "of_line"])


def _similar(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line) of the pairs' later lines whose words are similar enough to the earlier line's."""
    texts = _once(texts)
    one = texts.select(F.col("of_doc").alias("doc_id"), F.col("of_line").alias("line"), F.col("body").alias("body_1"))
    two = texts.select(F.col("of_doc").alias("doc_2"), F.col("of_line").alias("line_2"), F.col("body").alias("body_2"))
    rows = pairs.join(one, ["doc_id", "line"]).join(two, ["doc_2", "line_2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (batch.slice(i, BODIES) for batch in batches for i in range(0, batch.num_rows, BODIES)):
            sides = []
            for name in ("body_1", "body_2"):
                words, _, first, _ = line_words(column(b, name))
                sides.append((words, first))
            both, n = common_words(*sides), sum(np.diff(first) for _, first in sides)
            mask = pa.array(100 * both >= percent * (n - both))
            yield pa.RecordBatch.from_arrays([column(b, n).filter(mask) for n in ("doc_id", "line")], ["doc_id", "line"])

    return rows.select("doc_id", "line", "body_1", "body_2").mapInArrow(run, "doc_id long, line int")


def line_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, removed (line numbers from 0, ascending)."""
    unnamed = F.shiftrightunsigned(F.xxhash64(text_col), 2) + F.lit(_LAST)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), unnamed).alias("doc_id"), F.col(text_col).alias("text"))
    rows = _pairs(source, percent)
    copies = rows.filter("doc_id is not null and doc_2 is null").select("doc_id", "line")
    pairs = written(_open(rows.filter("doc_2 is not null"), copies).groupBy(*_ENDS)
                    .agg(F.max("first").alias("first"), F.max("more").alias("more")), "pairs")
    # the earliest candidate of each group settles most lines, the next few nearly all others; lines that are still open
    # and have further candidates are dealt out again, by themselves, and look at all of them
    texts = written(_line_texts(source, *_wanted(pairs)), "texts")
    near = written(_similar(pairs.filter("first"), texts, percent).distinct(), "settled")
    rest = written(_open(pairs.filter("not first"), near).select(*_ENDS), "pairs")
    near = near.unionByName(written(_similar(rest, _texts_of(texts, *_wanted(rest)), percent).distinct(), "settled"))
    left = written(_open(pairs.filter("more").select("doc_id", "line").distinct(), near), "open")
    if not left.isEmpty():
        # the marks may be of other lines too
        groups = rows.filter(F.col("kind") == _OPEN).select(*_PACKED)
        members = written(_members(groups, percent, _line_marks(left), GROUP), "members")
        texts = written(_line_texts(source, members, _slots(members.count())), "texts")
        near = near.unionByName(written(_similar_in_groups(members, texts, percent).distinct(), "settled"))

    late = (copies.unionByName(near).groupBy("doc_id")
            .agg(F.sort_array(F.collect_set(F.col("line").cast("bigint"))).alias("removed")))
    text = F.coalesce("text", F.lit(""))
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    out = source.select("doc_id", n_lines.cast("long").alias("n_lines")).join(late, "doc_id", "left")
    return out.select(F.when(F.col("doc_id") < _LAST, F.col("doc_id")).alias("doc_id"), "n_lines",
                      F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"))


def _open(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """Rows (doc_id, line, ...) of lines that are not settled."""
    done = settled.select(F.col("doc_id").alias("d"), F.col("line").alias("k"))
    return rows.join(done, (rows["doc_id"] == done["d"]) & (rows["line"] == done["k"]), "left_anti")


def _line_marks(lines: DataFrame) -> np.ndarray:
    """Filter of FILTER slots with the lines' slots set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, line = (column(b, n).to_numpy(zero_copy_only=False) for n in ("doc_id", "line"))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(line_slots(doc, line)))], ["slot"])

    out = np.zeros(FILTER, bool)
    out[lines.mapInArrow(run, "slot long").distinct().toPandas()["slot"].to_numpy(np.int64)] = True
    return out


def _wanted(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, line) of the lines of the pairs, and the slots of a filter for them."""
    return pairs.select("doc_id", "line").unionByName(
        pairs.select(F.col("doc_2").alias("doc_id"), F.col("line_2").alias("line"))), _slots(pairs.count())


def _slots(count: int) -> int:
    size = FILTER
    while size < MOST and size < 8 * count:
        size *= 2
    return size


def drop_lines(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without the removed lines; a document that loses no line is unchanged."""
    gone = line_duplicates(docs, percent, id_col, text_col).filter("size(removed) > 0 and doc_id is not null")
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("removed").alias("__gone")).dropDuplicates(["__id"])
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("__gone", i.cast("bigint"))), "\n")
    return (docs.join(gone, docs[id_col] == gone["__id"], "left")
            .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept)).drop("__id", "__gone"))
