import math
import os
import tempfile

from pyspark.sql import functions as F

from bankspark.operators import models as MD
from bankspark.plans import market as M
from bankspark.sources.roles import Roles
from bankspark.sources.text import PRICE_HEADER_MAP, read_price_csv
from tests.conftest import SF01


def test_price_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="bankspark-csv-")
    path = os.path.join(d, "prices.csv")
    header = ",".join(f'"{h}"' for h in PRICE_HEADER_MAP)
    lines = [header,
             '"15/12/2023","1,234.5","1,230.0","1,240.0","1,220.0","3.4K","-1.2%"',
             '"16/12/2023","1,300.25","-","","x","5M","0.5%"',
             '"17/12/2023","","","","","1.5B",""']
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    df = M.clean_prices(read_price_csv(spark, path)).orderBy("Date").collect()
    assert [r.Close for r in df] == [1234.5, 1300.25, None]
    assert [r.Open for r in df] == [1230.0, None, None]
    assert [r.Volume for r in df] == [3400.0, 5_000_000.0, 1_500_000_000.0]
    assert [r["Change %"] for r in df] == [-1.2, 0.5, None]
    assert str(df[0].Date) == "2023-12-15"


def test_sheet_to_long_and_back(spark):
    long = Roles(spark, SF01).macro_long()
    years = sorted(r[0] for r in long.select("year").distinct().collect())
    sheet = M.years_to_columns(long, years)
    assert sheet.columns[1] == f"{years[0]} [YR{years[0]}]"
    back = M.sheet_to_long(sheet, ["GDP", "Inflation", "Unemployment_rate"])
    a = sorted((r[0], r[1], r[2]) for r in back.collect())
    b = sorted((r.series_name, r.year, r.value) for r in long.collect())
    assert a == b


def test_kmeans_canonical_is_deterministic(spark):
    rows = [(float(x), float(y)) for x, y in [(0, 0), (0.1, 0), (5, 5), (5.1, 5), (9, 0), (9, 0.2), (0, 9), (0.1, 9)]]
    df = spark.createDataFrame(rows, "a double, b double")
    l1, c1, _ = MD.kmeans_canonical(df, ["a", "b"], 4, 42)
    l2, c2, _ = MD.kmeans_canonical(df.repartition(3), ["a", "b"], 4, 7)
    m1 = {(r.a, r.b): r.cluster for r in l1.collect()}
    m2 = {(r.a, r.b): r.cluster for r in l2.collect()}
    assert m1 == m2 and c1 == sorted(c1)
    lab = MD.assemble(l1.drop("features"), ["a", "b"])
    assert MD.davies_bouldin(lab, ["a", "b"]) < 0.1
    assert MD.silhouette_sq_euclidean(lab) > 0.9


def test_kmeans_goes_on_until_the_centres_stand_still(spark):
    """Evenly spaced points: centres creep, for more than 400 iterations."""
    df = spark.range(50000).select((F.col("id") * 100.0).alias("a")).coalesce(1)
    labelled, centres, _ = MD.kmeans_canonical(df, ["a"], 20, 42)
    means = {r.cluster: r.m for r in labelled.groupBy("cluster").agg(F.avg("a").alias("m")).collect()}
    assert len(centres) == 20 and all(abs(means[i] - c[0]) < 1e-3 for i, c in enumerate(centres))


def _plain_kmeans(points, k):
    """points: (key, coordinates); farthest-first seeds and Lloyd's rounds, point by point."""
    points = [p for _, p in sorted(points)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    mean = [sum(p[d] for p in points) / len(points) for d in range(len(points[0]))]
    centres = [max(points, key=lambda p: gap(p, mean))]
    while len(centres) < k and max(min(gap(p, c) for c in centres) for p in points) > 0:
        centres.append(max(points, key=lambda p: min(gap(p, c) for c in centres)))
    for _ in range(200):
        of = [min(range(len(centres)), key=lambda j: gap(p, centres[j])) for p in points]
        groups = [[p for p, o in zip(points, of) if o == j] for j in range(len(centres))]
        centres = [[sum(x) / len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centres)]
    return sorted(centres), sum(min(gap(p, c) for c in centres) for p in points)


def test_kmeans_of_every_k_equals_a_plain_version(spark):
    import random
    rng = random.Random(1)
    points = [(i, [rng.gauss(4 * (i % 5), 1), rng.gauss(3 * (i % 3), 1)]) for i in range(120)] + [(200, [0.0, 0.0]), (201, [0.0, 0.0])]
    df = spark.createDataFrame([(i, *p) for i, p in points], "id long, a double, b double").repartition(6)
    got = MD.kmeans_all(df, ["a", "b"], list(range(1, 8)), "id")
    for k, c in got.items():
        centres, inertia = _plain_kmeans(points, k)
        assert math.isclose(c.inertia, inertia, rel_tol=1e-9) and len(c.centres) == k
        assert all(math.isclose(x, y, abs_tol=1e-9) for p, q in zip(c.centres, centres) for x, y in zip(p, q))
    again = MD.kmeans_all(df.repartition(2), ["a", "b"], [4], "id")[4]
    assert math.isclose(again.inertia, got[4].inertia, rel_tol=1e-12)
    labelled = MD.assign_clusters(df, ["a", "b"], got[4].centres).groupBy("cluster").count().collect()
    assert {r.cluster for r in labelled} == {0, 1, 2, 3} and sum(r["count"] for r in labelled) == 122


def test_kmeans_ties_repeats_and_gaps(spark):
    import pytest
    df = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, 10.0), (4, 0.0)], "id long, a double")
    assert MD.farthest_first(df, ["a"], "id", 5) == [[0.0], [10.0]]  # both ends are as far: the smaller key
    found = MD.kmeans_all(df, ["a"], [1, 2, 3], "id")
    assert found[1].inertia == 100.0 and found[2].inertia == 0.0 and found[3].centres == [[0.0], [10.0]]
    with pytest.raises(ValueError):
        MD.kmeans_all(df.union(spark.createDataFrame([(5, None)], "id long, a double")), ["a"], [2], "id")
    with pytest.raises(ValueError):
        MD.kmeans_all(df.limit(0), ["a"], [2], "id")


def test_elbow_k1_is_total_variance(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "a double")
    pts = dict(MD.elbow(df, ["a"], "a", ks=[1, 2]))
    assert pts[1] == 8.0 and pts[2] <= pts[1]


def test_hash_split_stable_and_balanced(spark):
    o = Roles(spark, SF01).t("orders").select("o_orderkey")
    a = MD.hash_split(o, "o_orderkey")
    b = MD.hash_split(o.repartition(7), "o_orderkey")
    ja = {r.o_orderkey: r.is_train for r in a.collect()}
    jb = {r.o_orderkey: r.is_train for r in b.collect()}
    assert ja == jb
    share = sum(ja.values()) / len(ja)
    assert abs(share - 0.8) < 0.02


def test_recursive_forecast_equals_loop(spark):
    coefs, icpt = [0.5, 0.3, 0.2], 1.0
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "w array<double>")
    got = MD.recursive_forecast(df, "w", coefs, icpt, 4).first().forecast
    w, exp = [1.0, 2.0, 3.0], []
    for _ in range(4):
        p = sum(a * b for a, b in zip(w, coefs)) + icpt
        exp.append(p)
        w = w[1:] + [p]
    assert all(math.isclose(a, b) for a, b in zip(got, exp))


def test_yearly_last_skips_nulls(spark):
    df = spark.createDataFrame([(1, "2020-12-30", 5.0), (2, "2020-12-31", None), (3, "2021-01-02", 7.0)],
                               "rid int, d string, Close double").withColumn("Date", F.to_date("d"))
    got = {r.Year: r.Close for r in M.yearly_last(df, "Close", "Date", "rid").collect()}
    assert got == {2020: 5.0, 2021: 7.0}


def test_rate_table_rejects_duplicate_months(spark):
    import pytest
    ok = spark.createDataFrame([(2024, 1, 5.0), (2024, 2, 6.0)], "Year int, Month int, Rate double")
    assert {str(r.month_start): r.Rate for r in M.monthly_rate_table(ok).collect()} == \
        {"2024-01-01": 5.0, "2024-02-01": 6.0}
    dup = ok.unionByName(ok.limit(1))
    with pytest.raises(Exception):
        M.monthly_rate_table(dup).collect()


def test_workbook_sheet_to_macro_table(spark, tmp_path):
    from bankspark.sources.text import read_sheet
    lines = ['"Series Name","Series Code","Country Name","Country Code","2004 [YR2004]","2005 [YR2005]"',
             '"GDP","G.1","X","XX","7.5","7.6"',
             '"Inflation","I.1","X","XX","7.8",".."',
             '"Unemployment_rate","U.1","X","XX","2.1","2.0"',
             '"","","","","",""',
             '"Data from database: example","","","","",""']
    path = str(tmp_path / "sheet.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    sheet = read_sheet(spark, path).drop("Series Code", "Country Name", "Country Code")
    long = M.sheet_to_long(sheet, ["GDP", "Inflation", "Unemployment_rate"])
    wide = {r.Year: r for r in M.macro_wide(long, year="Year", series="Series Name", value="Value").collect()}
    assert set(wide) == {2004, 2005}
    assert (wide[2004].GDP, wide[2004].Inflation, wide[2005].Inflation, wide[2005].Unemployment_rate) == \
        (7.5, 7.8, None, 2.0)
