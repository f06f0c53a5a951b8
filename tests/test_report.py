import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bankspark.plans import catalogue as cat
from bankspark.plans import report as rp
from bankspark.sources.roles import Roles
from tests.conftest import SF01

D = dt.date


def _gl(spark, rows):
    return spark.createDataFrame(rows, "account_code string, amount decimal(18,2), transaction_date date, "
                                       "analysis_code string")


def test_line_without_head_has_no_area_rows(spark):
    area = Roles(spark, SF01).area()
    gl = _gl(spark, [
        ("702000030002", Decimal("100.00"), D(2023, 1, 5), "00000000B"),   # line 14, area only
        ("716000000001", Decimal("50.00"), D(2023, 1, 5), "00000000C"),    # line 16 area
        ("716000000001", Decimal("10.00"), D(2023, 1, 5), "000000000"),    # line 16 head
        ("716000000001", Decimal("30.00"), D(2023, 1, 5), "00000000Z"),    # unknown area: in the share base
        ("790000050101", Decimal("-8.00"), D(2023, 1, 5), "000000000"),    # one code, lines 27 and 9
        ("850000000001", Decimal("1.00"), D(2023, 5, 5), "00000000B"),     # after the month: ignored
    ])
    cube = rp.gl_cube(gl, 2)
    assert {(r.sort_id, r.area_code) for r in cube.filter("area_code = '0'").collect()} == {(16, "0"), (27, "0"), (9, "0")}
    npl = spark.createDataFrame([("B", 0.1, 1.0, Decimal("1.00"), 2), ("C", 0.1, 1.0, Decimal("1.00"), 2)],
                                "area_code string, rate double, du_no double, du_no_sum decimal(38,2), n_months int")
    sales = spark.createDataFrame([("s1", "AREA_B", 1)], "sale_name string, area_name string, month int")
    m = {(r.sort_id, r.area_name): r.value for r in rp.area_measures(cube, npl, sales, area, 202302).collect()}
    assert (14, "AREA_B") not in m                       # no head rows for line 14
    kept = {(r.sort_id, r.area_name): r.value
            for r in rp.area_measures(cube, npl, sales, area, 202302, keep_without_head=True).collect()}
    assert kept[(14, "AREA_B")] == Decimal("100.00") and kept[(16, "AREA_C")] == Decimal("56.30")
    fine = {(r.sort_id, r.area_name): r.value
            for r in rp.area_measures(cube, npl, sales, area, 202302, share_digits=4).collect()}
    assert fine[(16, "AREA_C")] == Decimal("56.25")      # 50 + 0.625 * 10
    # line 16: share 50/80 = 0.625 -> 0.63; 50 + 0.63 * 10 = 56.30
    assert m[(16, "AREA_C")] == Decimal("56.30")
    head = {r.sort_id: r.value for r in rp.head_values(cube).collect()}
    assert head[27] == Decimal("-8.00") and head[9] == Decimal("-8.00") and head[14] is None
    # rollups: 4 = 10, 6 = -8, 7 = 4 + 6 = 2, 8 has no children with values, 1 = 7 + 9 = -6
    assert (head[4], head[6], head[7], head[8], head[1]) == \
        (Decimal("10.00"), Decimal("-8.00"), Decimal("2.00"), None, Decimal("-6.00"))


def test_allocation_properties_on_driver_data(spark):
    r = Roles(spark, SF01)
    area = r.area()
    npl = rp.npl_by_area(r.loan_kpi(), r.city(), area, 2)
    cube = rp.gl_cube(r.gl(), 2)
    m = rp.area_measures(cube, npl, r.sales_kpi(), area, 202302)
    vals = {(x.sort_id, x.area_name): x.value for x in m.collect()}
    heads = {x.sort_id: x.amount for x in cube.filter("area_code = '0'").collect()}
    own = {(x.sort_id, x.area_code): x.amount for x in cube.filter("area_code != '0'").collect()}
    names = dict(r.area().select("area_code", "area_name").collect())
    # Balance shares allocate the whole head amount, up to one cent per area
    for sid in cat.SHARE_OF_BALANCE:
        tot = sum(v for (s, _), v in vals.items() if s == sid)
        assert abs(tot - heads[sid]) <= Decimal("0.01") * 7
    # Own amount plus a headcount share of the head, shares add up to 1
    for sid in cat.SHARE_OF_HEADCOUNT:
        extra = sum(vals[(sid, names[c])] - own[(sid, c)] for c in names if (sid, c) in own)
        assert abs(extra - heads[sid]) <= Decimal("0.01") * 7
    # Shares are rounded to 2 places before use, so the head amount leaks by at most
    # areas x 0.005 x |head| plus one cent of rounding per area
    for sid in cat.SHARE_OF_AMOUNT:
        if sid not in heads:
            continue
        codes = [c for c in names if (sid, c) in own]
        extra = sum(vals[(sid, names[c])] - own[(sid, c)] for c in codes)
        bound = Decimal("0.005") * len(codes) * abs(heads[sid]) + Decimal("0.01") * len(codes)
        assert abs(extra - heads[sid]) <= bound
    # Parents are sums of their children
    for parent, lo, hi, _ in cat.ROLLUPS:
        for a in names.values():
            kids = [v for (s, n), v in vals.items() if n == a and lo <= s <= hi]
            if kids:
                assert vals[(parent, a)] == sum(kids)


def test_npl_weights_equal_month_loop(spark):
    kpi = spark.createDataFrame([
        (202301, "X", Decimal("100"), None, Decimal("0"), 1),
        (202302, "X", Decimal("200"), 202301, Decimal("10"), 3),
        (202302, "X", Decimal("50"), 202302, Decimal("5"), None),
        (202303, "X", Decimal("70"), 202301, Decimal("7"), 4),
    ], "kpi_month int, pos_city string, outstanding_principal decimal(18,2), write_off_month int, "
       "write_off_balance_principal decimal(18,2), max_bucket int")
    city = spark.createDataFrame([("X", "B")], "tinh string, area_code string")
    area = spark.createDataFrame([("B", "AREA_B")], "area_code string, area_name string")
    r = rp.npl_by_area(kpi, city, area, 2).first()
    # loop form: m=1: 100 + wo(<=1: 10+7) = 117; m=2: 250 + wo(<=2: 10+5+7) = 272 -> 389 / 2
    assert r.du_no == 389 / 2
    # bad (bucket > 2): m=1: 0 + (10+7) = 17; m=2: 200 + (10+7) = 217 -> 234
    assert abs(r.rate - 234 / 389) < 1e-15


def test_monthly_report_driver_and_duplicate_guard(spark):
    import pytest
    r = Roles(spark, SF01)
    out = rp.monthly_report(spark, r.gl(), r.loan_kpi(), r.city(), r.area(), r.sales_kpi(), month=2)
    assert set(out) == {"npl", "debt_groups", "head", "measure", "report", "detail", "scorecard"}
    assert out["report"].count() == out["measure"].select("sort_id").distinct().count()
    assert out["detail"].count() == out["report"].count()
    dup = out["measure"].unionByName(out["measure"].limit(1))
    with pytest.raises(Exception):
        rp.report_wide(dup, r.area(), ["AREA_B", "AREA_C", "AREA_D", "AREA_E", "AREA_F", "AREA_G", "AREA_H"]).collect()


def test_year_filter_reaches_parquet_scan(spark, tmp_path):
    gl = Roles(spark, SF01).gl()
    path = str(tmp_path / "gl")
    gl.write.parquet(path)
    stored = spark.read.parquet(path)
    cube = rp.gl_cube(stored, 3, year=1997)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = cube._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(transaction_date" in plan and "LessThan(transaction_date" in plan
    exp = (stored.filter((F.year("transaction_date") == 1997) & (F.month("transaction_date") <= 3))
           .count())
    assert exp > 0
    got = rp.gl_cube(stored.filter(F.year("transaction_date") == 1997), 3)
    assert sorted(cube.collect()) == sorted(got.collect())


def test_scorecard_edge_rows(spark):
    from bankspark.plans.scorecard import person_kpis, scorecard
    area = spark.createDataFrame([("B", "AREA_B"), ("C", "AREA_C")], "area_code string, area_name string")
    sales = spark.createDataFrame([
        ("A", "a@x", "AREA_B", 1, Decimal("100"), Decimal("10"), Decimal("0.5")),
        ("A2", "a@x", "AREA_B", 2, Decimal("50"), Decimal("20"), Decimal("0.4")),   # same email, 2nd name
        ("C", "c@x", "AREA_C", 1, None, Decimal("5"), Decimal("0.3")),               # NULL measure
        ("D", "d@x", "AREA_C", 3, Decimal("70"), Decimal("5"), Decimal("0.3")),      # after the cut-off
    ], "sale_name string, email string, area_name string, month int, loan_to_new decimal(18,2), "
       "psdn decimal(18,2), app_rate decimal(18,4)")
    npl = spark.createDataFrame([("B", 0.2, 1.0), ("C", 0.1, 1.0)], "area_code string, rate double, du_no double")
    measure = spark.createDataFrame(
        [(202302, sid, a, Decimal(v)) for sid in (10, 11, 12, 13) for a, v in (("AREA_B", "1.00"), ("AREA_C", "2.00"))],
        "month int, sort_id int, area_name string, value decimal(38,2)")
    out = scorecard(person_kpis(sales, 2), area, npl, measure, 2, 202302).collect()
    assert len(out) == 8 + 1                       # a@x fans out 2 x 2 x 2; d@x has no year-to-date row
    c = [r for r in out if r.email == "c@x"][0]
    assert c.ltn_avg is None and c.rank_ltn_avg == 1   # DESC puts NULL first
    a_ranks = sorted({r.rank_ltn_avg for r in out if r.email == "a@x"})
    assert a_ranks == [2, 3]
    assert {r.rank_npl_truoc_wo_luy_ke for r in out if r.email == "a@x"} == {2}   # 8 rows after c@x's lower rate
    assert c.rank_cir == 2 and c.rank_margin == 1  # CIR ascending, margin descending over the areas


def test_scorecard_gathers_only_persons_that_join(spark):
    """A thousand persons without an email in one area, and one email with fifty names, against the joins written out."""
    from bankspark.plans.scorecard import person_kpis, scorecard
    area = spark.createDataFrame([("B", "AREA_B"), ("C", "AREA_C")], "area_code string, area_name string")
    rows = [(f"N{i}", None, "AREA_B", 1, Decimal(i), Decimal(i % 7), Decimal("0.5")) for i in range(1000)]
    rows += [(f"E{i}", "e@x", "AREA_B", 2, Decimal(3 * i), Decimal(i % 5), Decimal("0.25")) for i in range(50)]
    rows += [("Z", "z@x", "NOWHERE", 1, Decimal(1), Decimal(1), Decimal(1)), ("Y", "y@x", None, 1, Decimal(1), Decimal(1), Decimal(1))]
    sales = spark.createDataFrame(rows, "sale_name string, email string, area_name string, month int, loan_to_new decimal(18,2), "
                                        "psdn decimal(18,2), app_rate decimal(18,4)")
    npl = spark.createDataFrame([("B", 0.2, 1.0), ("C", 0.1, 1.0)], "area_code string, rate double, du_no double")
    measure = spark.createDataFrame(
        [(202302, sid, a, Decimal(v)) for sid in (10, 11, 12, 13) for a, v in (("AREA_B", "1.00"), ("AREA_C", "2.00"))],
        "month int, sort_id int, area_name string, value decimal(38,2)")
    out = scorecard(person_kpis(sales, 2), area, npl, measure, 2, 202302)
    got = out.groupBy("email", "ltn_avg", "rank_ltn_avg", "psdn_avg", "rank_psdn_avg").count().collect()
    assert {r.email for r in got} == {"e@x"} and sum(r["count"] for r in got) == 50 ** 3
    ltn = sorted((float(r[4]) for r in rows), reverse=True)   # ranked over all persons, those without an email too
    psdn = sorted((float(r[5]) for r in rows), reverse=True)
    assert all(r.rank_ltn_avg == ltn.index(r.ltn_avg) + 1 and r.rank_psdn_avg == psdn.index(r.psdn_avg) + 1 for r in got)
    assert {(r.ltn_avg, r.psdn_avg) for r in got} == {(float(3 * i), float(j)) for i in range(50) for j in range(5)}


def test_gl_edge_rows(spark):
    area = Roles(spark, SF01).area()
    gl = _gl(spark, [
        ("702000030002", None, D(2023, 1, 5), "000000000"),                 # NULL amount, head
        ("702000030002", Decimal("8.00"), D(2023, 1, 6), "000000000"),      # head
        ("702000030002", Decimal("10.00"), D(2023, 1, 5), "0000"),          # short code: area ''
        ("702000030002", Decimal("30.00"), D(2023, 2, 5), "00000000B"),
        ("702000030002", Decimal("5.00"), D(2022, 1, 5), "00000000B"),      # other year, same month
    ])
    c_all = {(r.sort_id, r.area_code): r.amount for r in rp.gl_cube(gl, 2).collect()}
    assert c_all == {(14, "0"): Decimal("8.00"), (14, ""): Decimal("10.00"), (14, "B"): Decimal("35.00")}
    c_2023 = {(r.sort_id, r.area_code): r.amount for r in rp.gl_cube(gl, 2, year=2023).collect()}
    assert c_2023[(14, "B")] == Decimal("30.00")
    npl = spark.createDataFrame([("B", 0.1, 1.0, Decimal("1.00"), 2)],
                                "area_code string, rate double, du_no double, du_no_sum decimal(38,2), n_months int")
    sales = spark.createDataFrame([("s1", "AREA_B", 1)], "sale_name string, area_name string, month int")
    m = {(r.sort_id, r.area_name): r.value
         for r in rp.area_measures(rp.gl_cube(gl, 2), npl, sales, area, 202302).collect()}
    # share of B = round(35 / 45, 2) = 0.78; 35 + 0.78 * 8 = 41.24; the '' area gets no row
    assert m[(14, "AREA_B")] == Decimal("41.24") and len([k for k in m if k[0] == 14]) == 1


def test_monthly_running_total_dense_grid(spark):
    df = spark.createDataFrame([("k", 202311, Decimal("1.00")), ("k", 202401, Decimal("2.00")),
                                ("k", 202401, Decimal("3.00")), ("j", 202402, Decimal("4.00"))],
                               "key string, mk int, v decimal(18,2)")
    got = {(r.key, r.mk): r.v_cum for r in rp.monthly_running_total(df, ["key"], "mk", ["v"], 202311, 202402).collect()}
    assert got == {("k", 202311): 1, ("k", 202312): 1, ("k", 202401): 6, ("k", 202402): 6,
                   ("j", 202311): 0, ("j", 202312): 0, ("j", 202401): 0, ("j", 202402): 4}


def test_report_columns_follow_the_area_dimension(spark):
    """A dimension with names of its own fills its own columns."""
    r = Roles(spark, SF01)
    area = r.area().withColumn("area_name", F.concat(F.lit("Region "), F.col("area_code")))
    sales = r.sales_kpi().withColumn("area_name", F.concat(F.lit("Region "), F.substring("area_name", -1, 1)))
    city = r.city().withColumn("region_code", F.lit("R"))
    tables = rp.monthly_report(spark, r.gl(), r.loan_kpi(), city, area, sales, 2, 2023, region_col="region_code")
    names = [f"Region {c}" for c in "BCDEFGH"]
    wide = tables["report"].collect()
    assert tables["report"].columns == ["sort_id", *names]
    assert all(any(row[n] is not None for row in wide) for n in names)
    assert {x.area for x in tables["debt_groups"].collect()} == {"R"}


def test_npl_keeps_write_offs_of_loans_without_outstanding(spark):
    kpi = spark.createDataFrame([(202301, "P", None, 202301, Decimal("100.00"), 3), (202301, "P", Decimal("50.00"), None, None, 1)],
                                "kpi_month int, pos_city string, outstanding_principal decimal(18,2), write_off_month int, "
                                "write_off_balance_principal decimal(18,2), max_bucket int")
    city = spark.createDataFrame([("P", "B")], "tinh string, area_code string")
    area = spark.createDataFrame([("B", "x"), ("C", "y")], "area_code string, area_name string")
    got = {x.area_code: (x.rate, float(x.du_no_sum)) for x in rp.npl_by_area(kpi, city, area, 2, 2023).collect()}
    assert got == {"B": (0.8, 250.0), "C": (None, 0.0)}
