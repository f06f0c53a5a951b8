import random

import pytest

import corpus_pipeline
from bankspark.llm import queries
from tests.llm import brute
from tests.llm.conftest import ODD


def test_five_stages_over_the_documents(spark):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    benchmark = [r["text"] for r in brute.rows("benchmark")]
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, brute.SF)
        rows = after.collect()
        kept = {r.doc_id for r in rows}
        assert len(rows) == len(kept) and kept <= set(before)
        if name == "quality classifier":
            low = {r["doc_id"] for r in brute.rows("labels") if r["quality"] == 0}
            good = {r["doc_id"] for r in brute.rows("labels") if r["quality"] == 1} & set(before)
            assert len(good & kept) > 0.9 * len(good) and len(low & kept) < 0.5 * len(low & set(before))
        elif name == "exact dedup":
            assert kept == {k for k, _, _ in brute.copies(list(before.items())).values()}
        elif name == "near-duplicates":
            assert kept == {i for i, (_, c) in brute.near(list(before.items()), 5, 80).items() if i == c}
        elif name == "benchmark decontamination":
            assert kept == {i for i, t in before.items() if not any(b in t for b in benchmark)}
        else:
            assert kept == set(before) and after.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            break
        assert after.columns == docs.columns
        before = {i: before[i] for i in kept}
        docs = spark.createDataFrame([tuple(r) for r in rows], docs.schema)
    got = {r.doc_id for r in corpus_pipeline.run(spark, brute.SF).collect()}
    assert got == kept


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randrange(999)) for _ in range(60)))
            for i in range(100, 160)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(100, 160)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(rows[5][1].split()[10:50])), (2, None)], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_odd_rows_and_clashing_columns(spark, odd, none, small):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        empty = stage(spark, none, small)
        assert empty.count() == 0
        if name != "bpe":
            assert out.columns == docs.columns and empty.columns == none.columns
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        if name in ("near-duplicates", "benchmark decontamination"):
            assert ids.count(None) == sum(i is None for i, _ in ODD)
        if name == "exact dedup":
            assert sorted(i for i in ids if i is not None) == [2, 3, 5, 6, 7, 8, 9, 10, 11, 12]


def test_registered(spark):
    assert sum(name.startswith("op") and name[2].isdigit() for name in queries.QUERIES) == 13
