"""Exact duplicate removal by distributed most-significant-byte-first radix partitioning.

Documents are split by the first bytes of their normalised text, the groups
that still hold more than one document by the next bytes, and so on, until
each group is a single document or its texts have ended.  Groups are compared
by the bytes themselves; no digest decides equality.  The number of bytes
taken grows by a factor per round, so texts of length L need O(log L) rounds,
and a round only reads the documents that are still undecided.

A round is one aggregate per (group, next bytes), with partial sums before the
shuffle, and one join of the rows to the groups that have more than one member.
Both sides of that join are read from written tables, so Spark can split the
partition of a hot group (a third of all rows with the same text).

Rows are told apart by (doc_id, place).  The place is 0 for a doc_id of one row;
the rows of a repeated doc_id are written once and numbered there, so the numbers
hold however often a task is run again, and one doc_id may hold any share of the rows.

Defined cases: null text counts as empty, so all null and empty texts are one
group; each row of a repeated doc_id is a row of its own: it counts in
``group_size`` of its own text's group, and all rows of the kept doc_id in a group
are marked as kept; ``keep_one_copy`` keeps one of them.  A row without doc_id is
never grouped and stays (a group of one; in ``keep_one_copy``, rows equal in all
columns stay once); an empty table gives an empty result; further columns are
ignored by ``exact_dedup`` and kept by ``keep_one_copy``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.llm.narrow import of_documents
from bankspark.session import written

FIRST_BYTES = 64
GROWTH = 8


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def with_places(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows, their columns as ``c0``, ``c1``, ..., with ``place``: (doc_id, place) is unique where doc_id is not null."""
    names = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(docs.columns)]
    key = f"c{docs.columns.index(id_col)}"
    rows = docs.select(*names)
    again = written(rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("again")).agg(F.count(F.lit(1)).alias("times"))
                    .filter("times > 1").select("again"), "radix")
    if again.isEmpty():
        return rows.withColumn("place", F.lit(0).cast("long"))
    on = rows[key] == again["again"]
    numbered = written(rows.join(again, on, "left_semi").withColumn("place", F.monotonically_increasing_id() + 1), "radix")
    return rows.join(again, on, "left_anti").withColumn("place", F.lit(0).cast("long")).unionByName(numbered)


def duplicate_groups(rows: DataFrame, first: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """(doc_id, place, top, group_size) of every row (doc_id, place, text) whose normalised text occurs on more than one
    row; ``top`` is the (doc_id, place) that stays: the largest doc_id, of its rows the first."""
    source = rows.filter("doc_id is not null")
    # every character takes a byte or more, so the first bytes come from the first characters
    start = source.select("doc_id", "place", F.lit(None).cast(f"struct<id:{source.schema['doc_id'].dataType.simpleString()},"
                                                              "back:bigint>").alias("grp"),
                          F.substring(F.encode(ascii_lower(F.substring("text", 1, first)), "UTF-8"), 1, first)
                          .alias("piece"))
    active = _split(start, first)
    ended = [active.filter("ended")]
    going = active.filter("not ended")
    at, width = first, first * growth
    if going.isEmpty():
        return _result(ended)
    open_ids = going.select("doc_id").distinct()
    texts = written(of_documents(source, open_ids)
                    .select("doc_id", "place", F.encode(ascii_lower(F.col("text")), "UTF-8").alias("body")), "radix")
    while not going.isEmpty():
        open_rows = going.select(F.col("doc_id").alias("row_id"), F.col("place").alias("row_place"), "grp")
        # only the next bytes of texts that reach this far are shuffled, so a text moves about once over all rounds
        ahead = (texts.filter(F.octet_length("body") >= at)
                 .select("doc_id", "place", F.substring("body", at + 1, width).alias("piece")))
        pieces = (ahead.join(open_rows, (ahead["doc_id"] == open_rows["row_id"]) & (ahead["place"] == open_rows["row_place"]))
                  .select("doc_id", "place", "grp", "piece"))
        active = _split(pieces, width)
        ended.append(active.filter("ended"))
        going = active.filter("not ended")
        at, width = at + width, width * growth
    return _result(ended)


def _split(rows: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, place, grp, piece) of the groups with several rows, under their new group."""
    rows = written(rows, "radix")
    top = F.max(F.struct(F.col("doc_id").alias("id"), (-F.col("place")).alias("back")))
    groups = written(rows.groupBy("grp", "piece").agg(F.count(F.lit(1)).alias("size"), top.alias("top"))
                     .filter("size > 1"), "radix")
    g = groups.select(F.col("grp").alias("g"), F.col("piece").alias("p"), "size", "top")
    return written(rows.join(g, rows["grp"].eqNullSafe(g["g"]) & (rows["piece"] == g["p"]))
                   .select("doc_id", "place", F.col("top").alias("grp"), "size",
                           (F.octet_length("piece") < width).alias("ended")), "radix")


def _result(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    top = F.struct(F.col("grp.id").alias("doc_id"), (-F.col("grp.back")).alias("place"))
    return out.select("doc_id", "place", top.alias("top"), F.col("size").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """One row per row of the input: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text, for reports)."""
    rows = with_places(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))) \
        .toDF("doc_id", "text", "place")
    groups = duplicate_groups(rows, first, growth).select(
        F.col("doc_id").alias("member"), F.col("place").alias("at"), F.col("top.doc_id").alias("keep_id"), "group_size")
    rows = rows.select("doc_id", "place", F.sha2(F.encode(ascii_lower(F.col("text")), "UTF-8"), 256).alias("text_sha256"))
    return (rows.join(groups, (rows["doc_id"] == groups["member"]) & (rows["place"] == groups["at"]), "left")
            .select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
                    F.coalesce(F.col("keep_id").isNull() | (F.col("keep_id") == F.col("doc_id")), F.lit(False))
                    .alias("kept"), "text_sha256"))


def keep_one_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without exact duplicates, all columns; of equal texts one row stays, whatever its other columns."""
    rows = with_places(docs, id_col)
    key, text = (f"c{docs.columns.index(n)}" for n in (id_col, text_col))
    groups = duplicate_groups(rows.select(F.col(key).alias("doc_id"), "place", F.col(text).alias("text")))
    losers = written(groups.filter(F.struct("doc_id", "place") != F.col("top"))
                     .select(F.col("doc_id").alias("member"), F.col("place").alias("at")), "radix")
    kept = rows.join(losers, (rows[key] == losers["member"]) & (rows["place"] == losers["at"]), "left_anti").drop("place")
    named = kept.filter(F.col(key).isNotNull())
    unnamed = kept.filter(F.col(key).isNull()).dropDuplicates()
    return named.unionByName(unnamed).toDF(*docs.columns)
