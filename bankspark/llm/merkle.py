"""Merkle dataset manifest: a digest per row, one tree per group, one tree over the groups, and a proof per row.

A leaf is the digest of a row's fields.  The leaves of a group, in order, are reduced ``ARITY`` at a time until one
node remains, the subroot; the subroots, in the order of their groups, are reduced likewise to the root.

The trees are built by exchanging subtrees.  A group's nodes are cut into superblocks of ``ARITY ** depth``
consecutive ones, which become one node each; only those go on, as the nodes of the next round, so a
group that holds a third of all rows is many superblocks and shrinks by that factor a round.  From the root the rounds
are walked back: every round's nodes and the outer nodes that their superblock needs (one row a superblock:
the siblings on the way from its top to the root) are cogrouped by superblock, and one function finishes the
local reduction, joins the proofs and, for the rows, folds each claimed leaf with its proof.  A task
holds one superblock at a time and the driver holds the number of rounds.

Digests are lowercase hexadecimal sha256 of concatenated inputs, inner digests as hexadecimal text.

Defined cases: a null field counts as ``-``, and differs from an empty one; null groups are a group, the first, and
null order values come first in theirs; rows that tie are ordered by their leaves, so repeated rows are separate
leaves and the result does not depend on partitioning; a single row's leaf is subroot and root, and its proof
is empty; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.operators.joins import attach_small
from bankspark.operators.series import G, with_index
from bankspark.session import written

ARITY = 3
DEPTH = 5     # levels of a superblock: 243 rows
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "grp long, pos long, n long, digest string"
_WAY = "before array<string>, after array<string>, subroot string, root string"


def leaf(values: list[Column]) -> Column:
    """Digest of a row's values: each ``-`` if null, else its UTF-8 length, a colon and its text."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(v) for v in values]).cast("binary"), 256)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id",
             claimed: dict[str, Column] | None = None, depth: int = DEPTH, proofs: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``order`` and ``group`` columns, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``claimed`` gives fields of the rows as someone else claims them: folded_root is the root that the claimed leaf and
    the true siblings lead to, and verified whether that is the root.  proof_sha256 is the digest of the siblings from
    the leaf's up to the root's, left to right.  With ``proofs``, the arrays ``before`` and ``after`` hold the siblings
    to the left and to the right of the way, one text a level.
    """
    claim = [(claimed or {}).get(f, F.col(f)) for f in fields]
    leaves = written(docs.select(F.col(order).alias("__order"), F.col(group).alias("__group"),
                                 leaf([F.col(f) for f in fields]).alias("digest"), leaf(claim).alias("claimed")), "leaves")
    placed = with_index(leaves, "__group", ["__order", "digest"])
    # a group is known by the position of its first row, which orders the groups as their names do
    groups = written(placed.groupBy("__group").agg(F.min(G).alias("grp"), F.count(F.lit(1)).alias("n"))
                     .withColumnRenamed("__group", "__of"), "groups")
    nodes = attach_small(placed, groups, F.col("__group").eqNullSafe(F.col("__of"))) \
        .withColumn("pos", F.col(G) - F.col("grp")).drop("__of", G)
    sizes = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    if not sizes[1]:
        return _renamed(nodes, order, group, proofs, empty=True)
    rounds = _climb(nodes.select("grp", "pos", "n", "digest"), sizes[0], depth)
    # one tree over the subroots
    subroots = with_index(rounds[-1].select("grp", F.lit(0).alias("all"), "digest"), "all", ["grp"])
    upper = subroots.select(F.lit(0).cast("long").alias("grp"), F.col(G).alias("pos"), F.lit(sizes[1]).alias("n"), "digest",
                            F.col("grp").alias("of_group"))
    tops = _climb(upper.select("grp", "pos", "n", "digest"), sizes[1], depth)
    none = F.array().cast("array<string>")
    ways = tops[-1].select("grp", "pos", none.alias("before"), none.alias("after"), F.lit(None).cast("string").alias("subroot"),
                           F.col("digest").alias("root"))
    for level in reversed(tops[1:-1]):
        ways = written(_descend(level, ways, depth, f"grp long, pos long, {_WAY}"), "ways")
    if len(tops) > 1:
        ways = _descend(upper, ways, depth, f"of_group long, {_WAY}").withColumnRenamed("of_group", "grp")
    else:  # a single group
        ways = ways.drop("grp").crossJoin(upper.select(F.col("of_group").alias("grp")))
    # the way of a group's top node; its subroot is the node itself
    ways = written(ways.select("grp", F.lit(0).cast("long").alias("pos"), "before", "after", "root")
                   .join(rounds[-1].select(F.col("grp").alias("__g"), F.col("digest").alias("subroot")),
                         F.col("grp") == F.col("__g")).select("grp", "pos", "before", "after", "subroot", "root"), "ways")
    for level in reversed(rounds[1:-1]):
        ways = written(_descend(level, ways, depth, f"grp long, pos long, {_WAY}"), "ways")
    kinds = {c: nodes.schema[c].dataType.simpleString() for c in ("__order", "__group")}
    out = f"__order {kinds['__order']}, __group {kinds['__group']}, digest string, {_PROVED}"
    out = out + ", before array<string>, after array<string>" if proofs else out
    return _renamed(_descend(nodes, ways, depth, out, single=len(rounds) == 1), order, group, proofs)


_PROVED = "subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _renamed(rows: DataFrame, order: str, group: str, proofs: bool, empty: bool = False) -> DataFrame:
    if empty:
        text, many = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
        rows = rows.select("__order", "__group", "digest", *[text.alias(c) for c in ("subroot", "root", "proof_sha256",
                           "folded_root")], F.lit(None).cast("boolean").alias("verified"), many.alias("before"),
                           many.alias("after"))
    return rows.select(F.col("__order").alias(order), F.col("__group").alias(group), F.col("digest").alias("leaf"), "subroot",
                       "root", "proof_sha256", "folded_root", "verified", *(["before", "after"] if proofs else []))


# ---- functions of one superblock --------------------------------------------------------------------------------


def _hash(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def _height(n: int) -> int:
    """Levels from n nodes to one."""
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def _levels(digests: list[str], n: int, depth: int) -> list[list[str]]:
    """The superblock's nodes, level by level; it is one of several if its group's n nodes fill more than one."""
    out = [digests]
    for _ in range(min(depth, _height(n))):
        below = out[-1]
        out.append([_hash("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return out


def _sides(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """For each level but the last and each node, its siblings to the left and to the right, joined."""
    out = []
    for nodes in levels[:-1]:
        level = []
        for i in range(0, len(nodes), ARITY):
            run = nodes[i:i + ARITY]
            level += [("".join(run[:k]), "".join(run[k + 1:])) for k in range(len(run))]
        out.append(level)
    return out


def _climb(nodes: DataFrame, widest: int, depth: int) -> list[DataFrame]:
    """The rounds of nodes: the given ones, then a node a superblock each, until every group has one node."""
    import pandas as pd

    size = ARITY ** depth

    def top(key, rows):
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n // size)],
                             "digest": _levels(rows["digest"].tolist(), n, depth)[-1]})

    rounds = [nodes]
    while widest > 1:
        block = F.floor(F.col("pos") / size).alias("block")
        rounds.append(written(rounds[-1].groupBy("grp", block).applyInPandas(top, _NODE), "nodes"))
        widest = -(-widest // size)
    return rounds


def _descend(nodes: DataFrame, ways: DataFrame, depth: int, out: str, single: bool = False) -> DataFrame:
    """Nodes of one round with their way to the root, from the ways of their superblocks (``grp``, ``pos``).

    With ``single``, the ways are those of the nodes themselves (every group has one).
    """
    import pandas as pd

    size = ARITY ** depth
    columns = [c.strip().split()[0] for c in out.split(",")]
    prove = "verified" in columns

    def join(_, rows, outer):
        rows = rows.sort_values("pos")
        way = outer.iloc[0]
        before, after, root = list(way["before"]), list(way["after"]), way["root"]
        n = int(rows["n"].iloc[0])
        sides = [] if single else _sides(_levels(rows["digest"].tolist(), n, depth))
        befores, afters, proofs, folded = [], [], [], []
        for i in range(len(rows)):
            own, at = [], i
            for level in sides:
                own.append(level[at])
                at //= ARITY
            left, right = [b for b, _ in own] + before, [a for _, a in own] + after
            befores.append(left)
            afters.append(right)
            if prove:
                proofs.append(_hash("".join([b + a for b, a in zip(left, right)])))
                node = rows["claimed"].iloc[i]
                for b, a in zip(left, right):
                    node = _hash(b + node + a)
                folded.append(node)
        rows = rows.assign(before=befores, after=afters, subroot=way["subroot"], root=root)
        if prove:
            rows = rows.assign(proof_sha256=proofs, folded_root=folded, verified=[f == root for f in folded])
        return rows[columns]

    block = F.lit(0).cast("long") if single else F.floor(F.col("pos") / size)
    return (nodes.withColumn("block", block).groupBy("grp", "block")
            .cogroup(ways.withColumnRenamed("pos", "block").groupBy("grp", "block")).applyInPandas(join, out))
