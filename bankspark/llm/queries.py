"""One registered query per numbered operator, with DuckDB text where SQL can express it.

Each query reads its whole table, runs its operator with production parameters
and derives the digest columns from the operator's rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark.llm import bpe, decontaminate, exact_dedup, language_id, lexical, line_dedup, merkle, minhash, quality, suffix_dedup, token_counts, token_files, url_filter
from bankspark.session import ensure_checkpoint_dir


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _remainder(id_col: str, n: int) -> Column:
    """crc32 of the id's decimal text modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def vocabulary_path() -> str:
    """The public vocabulary file of the tokenizers library; installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_read(spark, sf_dir, "documents"), vocabulary_path(), {"doc_id": F.col("doc_id")})


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                        F.array_join(F.col("removed").cast("array<string>"), " ").alias("removed_lines"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), words=3, percent=85)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.cut_text(_read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


END_ID = 1


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = token_files.write_tokens(_read(spark, sf_dir, "documents"), vocabulary_path(), END_ID)
    return token_files.read_tokens(spark, segments)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.train(docs.filter(~held_out).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"),
                                                            "text"))
    return language_id.identify(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False))
    return quality.score(docs, quality_model(docs, _read(spark, sf_dir, "labels")),
                         {"doc_id": F.col("doc_id"), "held_out": held_out})


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Learnt from the labels of documents that are not held out."""
    known = (labels.filter(_remainder("doc_id", 5) != 0)
             .select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    return quality.train(known, docs.select(F.col("doc_id").alias("id"), "text"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


OP9_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

# Fixed values of the url filter's contract.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_read(spark, sf_dir, "pages"), URL_RULES)



def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, against copies of which every second has lost its line ends."""
    claimed = {"text": F.when(_remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit("")))
               .otherwise(F.col("text"))}
    return merkle.manifest(_read(spark, sf_dir, "documents"), claimed=claimed).drop("source")


#: crc32 of a decimal number, bit by bit, and the digest input of a column.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
 lambda c: ascii(c)::BIGINT)), lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0],
 lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295)"""


def _sql_leaf(text: str) -> str:
    parts = [f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


OP11_SQL = f"""
WITH RECURSIVE d AS (
 SELECT doc_id, source, {_sql_leaf('text')} AS leaf,
  {_sql_leaf("CASE WHEN " + _CRC32 + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claimed FROM documents),
l AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
low AS (
 SELECT 0 AS lev, grp, pos, leaf AS h, count(*) OVER (PARTITION BY grp) AS n FROM l
 UNION ALL
 SELECT any_value(lev) + 1, grp, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
 FROM low WHERE n > 1 GROUP BY grp, pos // 3),
high AS (
 SELECT 0 AS lev, 0 AS grp, grp AS pos, h, count(*) OVER () AS n FROM low WHERE n = 1
 UNION ALL
 SELECT any_value(lev) + 1, 0, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
 FROM high WHERE n > 1 GROUP BY pos // 3),
nodes AS (SELECT false AS up, * FROM low UNION ALL SELECT true, * FROM high),
way AS (
 SELECT grp AS g0, pos AS p0, false AS up, 0 AS lev, grp, pos, claimed AS h, '' AS proof,
  EXISTS (SELECT 1 FROM low WHERE low.lev = 0 AND low.grp = l.grp AND low.n = 1) AS done FROM l
 UNION ALL
 SELECT g0, p0, CASE WHEN done THEN true ELSE w.up END, CASE WHEN done THEN 0 ELSE w.lev + 1 END,
  CASE WHEN done THEN 0 ELSE w.grp END, CASE WHEN done THEN w.grp ELSE w.pos // 3 END,
  CASE WHEN done THEN w.h ELSE sha256(coalesce(CASE WHEN w.pos % 3 = 0 THEN w.h ELSE a.h END, '') ||
   coalesce(CASE WHEN w.pos % 3 = 1 THEN w.h ELSE b.h END, '') || coalesce(CASE WHEN w.pos % 3 = 2 THEN w.h ELSE c.h END, '')) END,
  CASE WHEN done THEN proof ELSE proof || coalesce(CASE WHEN w.pos % 3 <> 0 THEN a.h END, '') ||
   coalesce(CASE WHEN w.pos % 3 <> 1 THEN b.h END, '') || coalesce(CASE WHEN w.pos % 3 <> 2 THEN c.h END, '') END,
  CASE WHEN done THEN (SELECT max(n) FROM high) = 1 ELSE a.n <= 3 END
 FROM way w
 LEFT JOIN nodes a ON a.up = w.up AND a.lev = w.lev AND a.grp = w.grp AND a.pos = w.pos // 3 * 3
 LEFT JOIN nodes b ON b.up = w.up AND b.lev = w.lev AND b.grp = w.grp AND b.pos = w.pos // 3 * 3 + 1
 LEFT JOIN nodes c ON c.up = w.up AND c.lev = w.lev AND c.grp = w.grp AND c.pos = w.pos // 3 * 3 + 2
 WHERE NOT (w.up AND w.done))
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
FROM l JOIN way w ON w.g0 = l.grp AND w.p0 = l.pos AND w.up AND w.done
JOIN low s ON s.grp = l.grp AND s.n = 1 CROSS JOIN (SELECT h FROM high WHERE n = 1) r
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts through a cache of its own, so every distinct text is encoded once in each run."""
    import public_tokenizers

    cache = f"{ensure_checkpoint_dir(spark)}/bankspark-token-cache-{uuid.uuid4().hex}"
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), cache, public_tokenizers.path("piece_bpe_32k.model"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def _sql_terms(table: str, columns: str) -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (f"SELECT {columns}, unnest(regexp_extract_all({lower}, "
            f"'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {table}")


OP13_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS ({_sql_terms('d', 'r')}),
tf AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
tot AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM len),
item AS (SELECT DISTINCT item_id, term FROM ({_sql_terms('benchmark', 'item_id')})),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, tot WHERE term IN (SELECT term FROM item) GROUP BY term),
s AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll))))::BIGINT AS score
      FROM item JOIN w USING (term) JOIN tf USING (term) JOIN len USING (r), tot GROUP BY item_id, r),
b AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
      FROM s JOIN d USING (r) WHERE score > 0)
SELECT * FROM b WHERE rank <= 50
"""

QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_bpe": op2_bpe, "op3_line_dedup": op3_line_dedup, "op4_minhash": op4_minhash, "op5_suffix_dedup": op5_suffix_dedup, "op6_language_id": op6_language_id, "op7_token_files": op7_token_files, "op8_quality": op8_quality, "op9_exact_dedup": op9_exact_dedup, "op10_url_filter": op10_url_filter,
           "op11_merkle": op11_merkle, "op12_token_counts": op12_token_counts, "op13_lexical": op13_lexical}
ORACLE = {"op9_exact_dedup": OP9_SQL, "op11_merkle": OP11_SQL, "op13_lexical": OP13_SQL}
