import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from bankspark.llm import merkle
from tests.llm.conftest import ODD


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """(root, siblings of each node on its way up, as (left, right) a level)."""
    at, ways = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for way, i in zip(ways, range(len(ways))):
            k = at[i]
            run = nodes[k // 3 * 3:k // 3 * 3 + 3]
            way.append(("".join(run[:k % 3]), "".join(run[k % 3 + 1:])))
            at[i] = k // 3
        nodes = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], ways


def plain(rows, claimed):
    """rows: (order, group, leaf values); claimed: other leaf values of each row."""
    first = lambda x: (x is not None, x.encode() if isinstance(x, str) else x)  # noqa: E731  nulls first, text by its bytes
    leaves = [(first(g), first(o), leaf(v), leaf(c), o, g) for (o, g, v), c in zip(rows, claimed)]
    groups = {}
    for x in sorted(leaves, key=lambda x: x[:3]):
        groups.setdefault(x[0], []).append(x)
    trees = {g: tree([x[2] for x in xs]) for g, xs in groups.items()}
    root, tops = tree([trees[g][0] for g in groups])
    out = []
    for (g, xs), top in zip(groups.items(), tops):
        for x, way in zip(xs, trees[g][1]):
            node = x[3]
            for left, right in way + top:
                node = H(left, node, right)
            out.append((x[4], x[5], x[2], trees[g][0], root, H(*[a + b for a, b in way + top]), node, node == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_trees_of_many_sizes(spark, depth):
    rng = random.Random(depth)
    docs = [(rng.randrange(10_000), g, f"t{rng.randrange(50)}\nx") for g, n in
            {None: 4, "": 1, "b": 2, "a": 3, "é": 9, "z": 10, "Z": 27, "hot": 270, "\U0001f600": 28, "￮": 5}.items()
            for _ in range(n)]
    docs += [docs[-1], docs[-1], (None, "hot", None)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(7)
    claimed = {"text": F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    fields = ("doc_id", "source", "text")
    got = merkle.manifest(frame, fields, claimed=claimed, depth=depth, proofs=True)
    want = plain([(i, s, (i, s, t)) for i, s, t in docs],
                 [(i, s, t.replace("\n", "") if i is not None and i % 2 == 0 else t) for i, s, t in docs])
    rows = got.collect()
    assert ordered([r[:8] for r in rows]) == ordered(want)
    assert all(r.verified == (r.doc_id is None or r.doc_id % 2 == 1) for r in rows)
    for r in rows[:50]:  # the proof's parts belong together
        assert r.proof_sha256 == H(*[b + a for b, a in zip(r.before, r.after)])


def test_one_group_and_one_row(spark):
    for n in (1, 2, 3, 4, 9, 10):
        docs = [(i, "s", "x") for i in range(n)]
        rows = merkle.manifest(spark.createDataFrame(docs, "doc_id long, source string, text string"),
                               ("doc_id", "text"), depth=1).collect()
        assert ordered(rows) == ordered(plain([(i, s, (i, t)) for i, s, t in docs], [(i, t) for i, s, t in docs]))
        assert n > 1 or (rows[0].leaf == rows[0].root == rows[0].subroot and rows[0].proof_sha256 == H(""))


def test_odd_rows_and_none(odd, none):
    rows = merkle.manifest(odd, ("doc_id", "lang", "text"), group="member").collect()
    assert len(rows) == len(ODD) and all(r.verified for r in rows) and len({r.root for r in rows}) == 1
    want = plain([(i, "y", (i, "x", t)) for i, t in ODD], [(i, "x", t) for i, t in ODD])
    assert ordered([r[:8] for r in rows]) == ordered(want)
    empty = merkle.manifest(none, proofs=True)
    assert empty.count() == 0 and empty.columns[:4] == ["doc_id", "source", "leaf", "subroot"]


def test_a_changed_row_changes_the_root(spark):
    docs = [(i, "ab"[i % 2], f"text {i}") for i in range(40)]
    schema = "doc_id long, source string, text string"
    fields = ("doc_id", "source", "text")
    root = merkle.manifest(spark.createDataFrame(docs, schema), fields).first().root
    docs[17] = (17, "b", "text 17 ")
    assert merkle.manifest(spark.createDataFrame(docs[::-1], schema), fields).first().root != root
