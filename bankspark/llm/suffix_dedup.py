"""Removal of repeated passages of 100 bytes or more with a logarithmic family of suffix indexes.

A byte goes if it is covered by a 100-byte string that also starts earlier (smaller doc_id, or same document
and earlier start) in the input.

Full suffix arrays of the corpus would take several times its size, so the arrays are sparse and sharded:

1. Every 100-byte window has an anchor, the position in it of the 32-gram of least hash (leftmost if equal).
   Equal windows have equal anchors, so the windows of one anchor, a stretch of about 135 bytes (an entry),
   can only match windows of entries with the same 32-gram.
2. A first pass counts the entries' 32-grams in hash slots.  Entries whose slot has no other entry match
   nothing and stay where they are.  The slot table has at most ``MAX_SLOT_BITS`` bits (32 MB as a bitmap).
   Beyond about 2^25 entries more entries travel; the result stays the same.
3. The other entries travel, with their bytes, to the shard of their 32-gram.  An entry whose bytes an earlier
   entry of the same task had is covered whole and sends no bytes.  The windows of a very frequent 32-gram travel
   one by one, each to the shard of its own hash, so no shard holds a group without bound.
4. A shard takes its entries in the order of doc_id and start, in batches.  Each new batch gets a suffix
   array: the starts of its 100-byte windows, in the order of a 64-bit fingerprint of those bytes.  It is
   merge-scanned against the existing levels, and windows that a level holds (a second 64-bit fingerprint must agree
   as well) are matches.  The windows that are new become a level; levels of equal size merge, so there are
   logarithmically many.  A shard with very many windows takes them in turns by fingerprint.
5. Runs of matching windows are byte ranges; a document's ranges meet its text and are cut out.

The order within an array is that of the fingerprints, not of the bytes: only whole 100-byte matches are asked
for, and runs of them give the long matches.

Defined cases: null text counts as empty; texts below 100 bytes lose nothing; repeated rows of a document are
the same document and do not remove each other; a row without doc_id neither loses nor removes bytes; an empty
table gives an empty result; further columns are ignored.  Cut points may fall inside a character, as asked for
bytes; ``cut_text`` decodes what is left with replacement characters there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import binary_array, column, text_bytes
from bankspark.llm.words import mix, span_hashes
from bankspark.session import written

WINDOW = 100
GRAM = 32
CHUNK = 1 << 19          # bytes hashed at once
MAX_SLOT_BITS = 28
RANGE_BITS = 18          # slots counted by one task at a time
HOT = 100_000            # entries of a 32-gram from which its windows travel one by one
SHARD_ENTRIES = 150_000  # entries (before the filter) to a shard
REMEMBERED = 200_000     # spans that a task or shard remembers
BATCH_ENTRIES = 4096     # of a new batch
PASS_WINDOWS = 1_500_000  # windows whose fingerprints a shard holds at a time
_BYTES = mix(np.arange(256) + 77)
_BYTES_2 = mix(np.arange(256) + 7777)
_LOW = np.uint64((1 << 20) - 1)


def entries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, last window start, hash of the anchor's 32-gram) of each entry; texts lie at the offsets."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    grams = mix(span_hashes(_BYTES[data], at, at + GRAM))
    least = (grams & ~_LOW) | at.astype(np.uint64)
    reach = WINDOW - GRAM + 1
    step = 1
    while 2 * step <= reach:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if reach > step:
        least = np.minimum(least[:step - reach], least[reach - step:])
    anchor = (least & _LOW).astype(np.int64)
    outside = np.zeros(len(data) + 1, np.int64)  # windows that begin in a text's last bytes
    ends = offsets[1:]
    np.add.at(outside, np.maximum(offsets[:-1], ends - WINDOW + 1), 1)
    np.add.at(outside, ends, -1)
    valid = np.cumsum(outside)[:n] == 0
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    finish = valid.copy()
    finish[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(finish), mix(grams[anchor[first]] ^ np.uint64(0x1234567))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, doc_id, base) of up to CHUNK bytes: whole texts, or a stretch of a longer one from base on."""
    data, offsets = text_bytes(column(batch, "text"))
    ids = column(batch, "doc_id").to_numpy(zero_copy_only=False)
    i, n = 0, len(ids)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        if offsets[j] - offsets[i] <= CHUNK:
            yield data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ids[i:j], np.zeros(j - i, np.int64)
        else:
            whole = data[offsets[i]:offsets[i + 1]]
            for base in range(0, len(whole) - WINDOW + 1, CHUNK):  # windows that begin in this stretch
                part = whole[base:base + CHUNK + WINDOW - 1]
                yield part, np.array([0, len(part)]), ids[i:i + 1], np.array([base])
            j = i + 1
        i = j


def _slot_rows(source: DataFrame, bits: int) -> DataFrame:
    """Per task: (range, slots, extra_slots, extra): distinct slots of its entries, and counts beyond one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            slots, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            parts = np.arange((1 << bits >> RANGE_BITS) + 1) << RANGE_BITS
            again = counts > 1
            few, extra = slots[again], counts[again] - 1
            cut, cut_few = np.searchsorted(slots, parts), np.searchsorted(few, parts)
            low = (1 << RANGE_BITS) - 1
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(parts) - 1, dtype=np.int32)),
                 binary_array((slots & low).astype("<u4").view(np.uint8), 4 * cut),
                 binary_array((few & low).astype("<u4").view(np.uint8), 4 * cut_few),
                 binary_array(np.minimum(extra, HOT).astype("<u4").view(np.uint8), 4 * cut_few)],
                ["range", "slots", "extra_slots", "extra"])

        for b in batches:
            for data, offsets, _, _ in _chunks(b):
                held.append((entries(data, offsets)[2] >> np.uint64(64 - bits)).astype(np.int64))
            if sum(map(len, held)) > 4_000_000:
                yield flush()
        if held:
            yield flush()

    return source.mapInArrow(run, "range int, slots binary, extra_slots binary, extra binary")


def _slot_table(source: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap of the slots with two entries or more, sorted slots with HOT or more)."""
    size = 1 << RANGE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, last = np.zeros(size, np.int64), None

        def done() -> pa.RecordBatch:
            hot = np.flatnonzero(counts >= HOT).astype("<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([last], pa.int32()), pa.array([np.packbits(counts > 1, bitorder="little").tobytes()]),
                 pa.array([hot.tobytes()])], ["range", "twice", "hot"])

        for b in batches:
            for k in range(b.num_rows):
                now = column(b, "range")[k].as_py()
                if last is not None and now != last:
                    yield done()
                    counts[:] = 0
                last = now
                slots, few, extra = (np.frombuffer(column(b, x)[k].as_py(), "<u4") for x in ("slots", "extra_slots", "extra"))
                counts[slots] += 1
                counts[few] += extra
        if last is not None:
            yield done()

    rows = (_slot_rows(source, bits).repartition("range").sortWithinPartitions("range")
            .mapInArrow(run, "range int, twice binary, hot binary").toArrow())
    twice, hot = np.zeros((1 << bits) // 8, np.uint8), []
    for r in rows.to_batches():
        for k in range(r.num_rows):
            part = column(r, "range")[k].as_py()
            twice[part * size // 8:(part + 1) * size // 8] = np.frombuffer(column(r, "twice")[k].as_py(), np.uint8)
            hot.append(np.frombuffer(column(r, "hot")[k].as_py(), "<u4").astype(np.int64) + part * size)
    return twice, np.sort(np.concatenate(hot)) if hot else np.zeros(0, np.int64)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _join_ranges(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges [lo, hi) that touch or overlap in the same document joined; the input is sorted by (doc, lo)."""
    if not len(doc):
        return doc, lo, hi
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])
    at = np.flatnonzero(new)
    return doc[at], lo[at], np.maximum.reduceat(hi, at)


def _travelling(source: DataFrame, bits: int, twice: np.ndarray, hot: np.ndarray) -> DataFrame:
    """(shard, doc_id, lo, hi, span): entries with window starts lo to hi and their bytes; without bytes, a covered range."""
    def rows(shard, doc, lo, hi, data, cuts, covered) -> pa.RecordBatch:
        d, a, z = covered
        none = len(d)
        spans = pa.concat_arrays([binary_array(data, cuts), pa.nulls(none, pa.binary())])
        arrays = [np.concatenate([shard.view(np.int64), mix(d ^ a).view(np.int64)]), np.concatenate([doc, d]),
                  np.concatenate([lo, a]), np.concatenate([hi, z])]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays] + [spans], ["shard", "doc_id", "lo", "hi", "span"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, int, int]] = {}  # fingerprint of a span: (second fingerprint, doc_id, start)
        for b in batches:
            for data, offsets, ids, base in _chunks(b):
                first, last, gram = entries(data, offsets)
                slot = (gram >> np.uint64(64 - bits)).astype(np.int64)
                pick = np.flatnonzero(twice[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                first, last, gram, slot = first[pick], last[pick], gram[pick], slot[pick]
                at = np.minimum(np.searchsorted(hot, slot), max(0, len(hot) - 1))
                very = hot[at] == slot if len(hot) else np.zeros(len(slot), bool)
                if very.any():  # one entry for each window, in the shard of its own hash
                    windows = _spread(first[very], (last - first + 1)[very])
                    own = mix(span_hashes(_BYTES_2[data], windows, windows + WINDOW))
                    first, last = np.concatenate([first[~very], windows]), np.concatenate([last[~very], windows])
                    gram = np.concatenate([gram[~very], own])
                    order = np.argsort(first, kind="stable")
                    first, last, gram = first[order], last[order], gram[order]
                text = np.searchsorted(offsets, first, "right") - 1
                doc, start = ids[text], first - offsets[text] + base[text]
                stop = last + WINDOW
                one = span_hashes(_BYTES[data], first, stop) + (stop - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                two = span_hashes(_BYTES_2[data], first, stop)
                if len(known) > REMEMBERED:
                    known.clear()
                keep = np.ones(len(first), bool)
                for k, (x, y, d, s) in enumerate(zip(one.tolist(), two.tolist(), doc.tolist(), start.tolist())):
                    before = known.get(x)
                    if before is None or (d, s) < before[1:]:
                        known[x] = (y, d, s)
                    elif before[0] == y and before[1:] < (d, s):
                        keep[k] = False
                lost = ~keep
                covered = _join_ranges(doc[lost], start[lost], (start + stop - first)[lost])
                first, stop, last = first[keep], stop[keep], last[keep]
                size = stop - first
                yield rows(gram[keep], doc[keep], start[keep], start[keep] + last - first, data[_spread(first, size)],
                           np.concatenate([[0], np.cumsum(size)]), covered)

    return source.mapInArrow(run, "shard long, doc_id long, lo long, hi long, span binary")


class Family:
    """Levels of sorted window fingerprints of one shard; sizes grow geometrically."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Which windows (in order of position) match an earlier one; the others become a level."""
        order = np.argsort(keys, kind="stable")
        keys, checks = keys[order], checks[order]
        match = np.zeros(len(keys), bool)
        match[1:] = (keys[1:] == keys[:-1]) & (checks[1:] == checks[:-1])
        for known, also in self.levels:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            match |= (known[at] == keys) & (also[at] == checks)
        if not match.all():
            self.levels.append((keys[~match], checks[~match]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            merged = np.concatenate([b, a])
            place = np.argsort(merged, kind="stable")  # two sorted runs: a merge
            self.levels.append((merged[place], np.concatenate([y, x])[place]))
        out = np.empty(len(keys), bool)
        out[order] = match
        return out


def _matches(travelling: DataFrame, shards: int) -> DataFrame:
    """(doc_id, lo, hi): byte ranges [lo, hi) to cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (gram, doc_id, lo, hi, bytes, offsets) of the shard's entries, in order
        seen: dict[int, int] = {}
        last = (-1, -1, -1)

        def ranges(doc, lo, hi) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _join_ranges(doc, lo, hi)], ["doc_id", "lo", "hi"])

        for b in batches:
            gram, doc, lo, hi = (column(b, x).to_numpy(zero_copy_only=False) for x in ("shard", "doc_id", "lo", "hi"))
            spans = column(b, "span")
            done = spans.is_null().to_numpy(zero_copy_only=False)
            yield ranges(doc[done], lo[done], hi[done])
            data, offsets = text_bytes(spans)
            again = np.zeros(len(doc), bool)  # a repeated row of the same document
            if len(doc):
                again[1:] = (doc[1:] == doc[:-1]) & (lo[1:] == lo[:-1]) & (hi[1:] == hi[:-1])
                again[0] = (doc[0], lo[0], hi[0]) == last
                last = (doc[-1], lo[-1], hi[-1])
            rows = np.flatnonzero(~done & ~again)
            start, stop = offsets[rows], offsets[rows + 1]
            one = span_hashes(_BYTES[data], start, stop) + (stop - start).astype(np.uint64) * np.uint64(31)
            two = span_hashes(_BYTES_2[data], start, stop)
            if len(seen) > REMEMBERED:
                seen.clear()
            whole = np.zeros(len(rows), bool)  # the same bytes as an earlier entry
            for k, (x, y) in enumerate(zip(one.tolist(), two.tolist())):
                whole[k] = seen.setdefault(x, y) == y if x in seen else bool(seen.update({x: y}))
            gone = rows[whole]
            yield ranges(doc[gone], lo[gone], hi[gone] + WINDOW)
            rows, start, size = rows[~whole], start[~whole], (stop - start)[~whole]
            held.append((gram[rows], doc[rows], lo[rows], hi[rows], data[_spread(start, size)], size))
        seen.clear()
        if not held:
            return
        gram, doc, lo, hi, data, size = (np.concatenate(x) for x in zip(*held))
        held.clear()
        # an entry whose 32-gram no other entry of the shard has matches nothing
        _, back, count = np.unique(gram, return_inverse=True, return_counts=True)
        keep = np.flatnonzero(count[back] > 1)
        data = data[_spread((np.cumsum(size) - size)[keep], size[keep])]
        doc, lo, hi, size = doc[keep], lo[keep], hi[keep], size[keep]
        start = np.cumsum(size) - size
        passes = np.uint64(-(-int((hi - lo + 1).sum()) // PASS_WINDOWS) or 1)
        for turn in range(int(passes)):  # each turn takes a share of the fingerprints, so the levels stay small
            family = Family()
            for i in range(0, len(doc), BATCH_ENTRIES):
                part = slice(i, i + BATCH_ENTRIES)
                base = start[i]
                text = data[base:(start[part] + size[part])[-1]]
                first, number = start[part] - base, hi[part] - lo[part] + 1
                window = _spread(first, number)
                keys = mix(span_hashes(_BYTES[text], window, window + WINDOW))
                own = np.flatnonzero(keys % passes == turn)
                window, owner = window[own], np.repeat(np.arange(len(first)), number)[own]
                match = family.add(keys[own], span_hashes(_BYTES_2[text], window, window + WINDOW))
                window, owner = window[match], owner[match]
                at = lo[part][owner] + window - first[owner]
                yield ranges(doc[part][owner], at, at + WINDOW)

    return (travelling.repartition(shards, "shard").sortWithinPartitions("doc_id", "lo", "hi")
            .mapInArrow(run, "doc_id long, lo long, hi long"))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ranges): the byte ranges [lo, hi) of each document that go; not yet joined, documents without any left out."""
    source = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"),
                                                           F.col(text_col).alias("text"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    expected = max(1, size * 2 // (WINDOW - GRAM + 2))
    bits = min(MAX_SLOT_BITS, max(20, math.ceil(math.log2(expected)) + 3))
    twice, hot = _slot_table(source, bits)
    found = written(_matches(_travelling(source, bits, twice, hot), max(1, -(-expected // SHARD_ENTRIES))), "ranges")
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("ranges"))


def cut_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (maximal removed runs [lo, hi)), kept (binary)."""
    ranges = repeated_ranges(docs, id_col, text_col).withColumnRenamed("doc_id", "of")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = source.join(ranges, source["doc_id"] == ranges["of"], "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_bytes(column(b, "text"))
            raw = memoryview(data)
            out: list[tuple] = []
            for k, found in enumerate(column(b, "ranges").to_pylist()):
                text = raw[offsets[k]:offsets[k + 1]]
                spans: list[list[int]] = []
                for r in found or ():
                    if spans and r["lo"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["hi"])
                    else:
                        spans.append([r["lo"], r["hi"]])
                edges = [0, *[x for s in spans for x in s], len(text)]
                out.append((len(text), spans, b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2]))))
            sizes, spans, kept = (list(x) for x in zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<array<long>>, kept binary")
