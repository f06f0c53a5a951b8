"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import xxhash
import zstandard

SF = "/root/testdata/sf0.001"


def rows(table: str, sf_dir: str = SF) -> list[dict]:
    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text: str | None, n: int) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def roots(nodes, edges) -> dict:
    parent = {x: x for x in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def near(docs: list[tuple], n: int, percent: int) -> dict:
    """{doc_id: (set size, component)}."""
    sets = {i: shingles(t, n) for i, t in docs if i is not None}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    edges = []
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                edges.append((i, j))
    found = roots(sets, edges)
    return {i: (len(s), found[i]) for i, s in sets.items()}


def removed_lines(docs: list[tuple], percent: int = 80) -> dict:
    """{doc_id: (lines, removed line numbers)}."""
    lines = [(i, k, frozenset(words(line))) for i, t in sorted(docs) for k, line in enumerate((t or "").split("\n"))]
    first: dict = {}
    for i, k, s in lines:
        if s:
            first.setdefault(s, (i, k))
    out: dict = {}
    for i, k, s in lines:
        entry = out.setdefault(i, [0, []])
        entry[0] += 1
        if s and any(p < (i, k) and 100 * len(s & o) >= percent * len(s | o) for o, p in first.items()):
            entry[1].append(k)
    return {i: tuple(e) for i, e in out.items()}


def cut(docs: list[tuple], size: int = 100) -> dict:
    """{doc_id: (bytes, removed, spans, sha256 of the rest)}."""
    seen: set = set()
    out = {}
    for i, t in sorted(docs):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            w = b[p:p + size]
            if w in seen:
                gone[p:p + size] = b"\x01" * size
            seen.add(w)
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest())
    return out


def copies(docs: list[tuple]) -> dict:
    """{doc_id: (keep_id, group size, sha256)}."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[lower(t)].append(i)
    return {i: (max(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}


def id_hash(i: int, seed: int) -> int:
    """Signed 64-bit hash of an id (8 bytes), then of the seed (4 bytes) from there on."""
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
    return h - (1 << 64) if h >> 63 else h


def class_samples(rows: list[tuple], per_class: int, seed: int, piece: int, dict_bytes: int) -> list[tuple]:
    """[(label, piece of text)] of rows (id, label, text): the least hash of each slot of a label, in hash order."""
    first: dict = {}
    for i, label, text in rows:
        h = id_hash(i, seed)
        slot = label, h % per_class
        if slot not in first or (h, i) < first[slot][:2]:
            first[slot] = h, i, label, text or ""
    count = Counter(label for _, _, label, _ in first.values())
    out = []
    for h, _, label, text in sorted(first.values(), key=lambda r: r[:2]):
        size = max(piece, dict_bytes // count[label])
        start = h % (max(len(text) - size, 0) + 1)
        out.append((label, text[start:start + size]))
    return out


def coded_size(data: bytes, dictionary: bytes, block: int) -> int:
    """Bytes that zstandard makes of data in blocks, each with the raw-content dictionary alone before it."""
    params = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, hash_log=16, chain_log=16, search_log=3, window_log=18,
        target_length=8, write_content_size=False, write_checksum=False, write_dict_id=False)
    raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(compression_params=params)
    blocks = [data[k:k + block] for k in range(0, len(data), block)] or [b""]
    return sum(len(zstandard.ZstdCompressor(dict_data=raw, compression_params=params).compress(b)) for b in blocks)
