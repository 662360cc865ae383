"""Sums without rounding, exact quantiles, and plans that read each table as often as they must."""

import random
import statistics
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rxlake.functions.codes import normalize_code, register_sql_function
from rxlake.functions.columns import exact, exact_avg, exact_part, exact_sum, exact_sum_of_parts, exact_total
from rxlake.operators import analysis, gold, prices
from rxlake.operators.keyed import exact_quantile
from rxlake.plans import driver_tables, registry
from rxlake.sources import scan_delimited, schemas


def test_sub_cent_amounts_count(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (None,)], "x double")
    row = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("m")).first()
    assert row.s == 0.012 and row.m == 0.004


def test_pivot_takes_all_types_and_rejects_unlisted(spark):
    df = spark.createDataFrame(
        [("1", "A", 1.0), ("1", "C/I", 2.0), ("2", None, 3.0)],
        "ndc string, pharmacy_type string, nadac_per_unit double",
    )
    rows = analysis.price_pivot(df).collect()
    assert [r.asDict() for r in rows] == [{"ndc": "1", "A": 1.0, "C/I": 2.0}]
    with pytest.raises(PySparkException, match="not listed"):
        analysis.price_pivot(df, ["A"]).collect()


def test_long_part_keys_are_an_error(spark):
    df = spark.createDataFrame([(1_000_000_000,)], "k long")
    with pytest.raises(PySparkException, match="more than nine digits"):
        df.selectExpr(driver_tables.raw_code("k")).collect()


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_quantile_is_exact_for_any_partitioning(spark, partitions, q):
    rnd = random.Random(3)
    rows = [(g, rnd.choice([rnd.random(), 5.0, 1e6 * rnd.random()])) for g in ("a", None) for _ in range(700)]
    rows += [("one", 7.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")

    def run(n):
        found = exact_quantile(df.repartition(n), ["g"], "v", q, slices=16, few=20).collect()
        return {r.g: r.v for r in found}

    results = partitions(run, (3, 40))
    for g in ("a", None, "one"):
        values = sorted(v for k, v in rows if k == g)
        want = values[max(1, len(values) - int(len(values) - q * len(values))) - 1]
        assert all(r[g] == want for r in results)
    assert all("none" not in r for r in results)


def test_many_values_per_type_are_counted_exactly(spark):
    n = 210_000
    df = spark.range(n).selectExpr(
        "CAST(id % 50 AS STRING) AS ndc", "'A' AS pharmacy_type",
        "CAST((id * 7919) % 210000 AS DOUBLE) / 1000 AS nadac_per_unit",
    )
    row = analysis.price_by_pharmacy_type(df).first()
    values = [i / 1000 for i in range(n)]
    assert row.price_observations == n and row.unique_drugs == 50
    assert row.median_nadac == round(values[n // 2 - 1], 4)
    assert row.stddev_nadac == pytest.approx(statistics.stdev(values), abs=1e-3)


def test_quantile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "total_rx_spend double")
    assert gold.spend_tiers(df).count() == 0


def test_price_features_read_prices_once(spark):
    df = spark.createDataFrame(
        [], "ndc string, nadac_per_unit double, effective_date date, rate_classification string"
    )
    plan = prices.price_anomaly_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Join" not in plan


def test_fill_summary_does_not_multiply_fills(spark):
    df = spark.createDataFrame(
        [],
        "beneficiary_id string, ndc string, total_rx_cost double, patient_pay_amount double, "
        "payer_paid_amount double, days_supply int, service_date date, service_year int",
    )
    plan = gold.patient_fill_summary(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


VECTORS = {
    "12345\x85": "00000012345",
    "\u00a01-2-3\u2028": "00001000203",
    "1-2-3\n": "00001000203",
    "12\x8545": None,
    "\u3000": None,
    "0002-1433-01": "00002143301",
}


def test_codes_with_white_space_of_unicode(spark):
    register_sql_function(spark)
    df = spark.createDataFrame(list(VECTORS.items()), "raw string, want string")
    for row in df.select("*", normalize_code(F.col("raw")).alias("a"), F.expr("normalize_ndc(raw)").alias("b")).collect():
        assert row.a == row.want and row.b == row.want, row


def test_vintages_with_other_headers(spark, tmp_path):
    (tmp_path / "y1.csv").write_text("A,B\n1,2\n")
    (tmp_path / "y2.csv").write_text("B,A\n4,3\n")
    (tmp_path / "y3.csv").write_text("A,C\n5,6\n")
    found = scan_delimited(spark, f"{tmp_path}/y*.csv", schemas.text_schema("A B"))
    assert sorted((r.A, r.B or "") for r in found.collect()) == [("1", "2"), ("3", "4"), ("5", "")]
    assert set(scan_delimited(spark, f"{tmp_path}/y*.csv").columns) == {"A", "B", "C"}
    with pytest.raises(ValueError, match="columns not in"):
        scan_delimited(spark, f"{tmp_path}/y*.csv", schemas.text_schema("A D"))


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_large_prices_and_overflows_in_both_modes(spark, ansi):
    rows = [("R", "1", 3e8), ("R", "2", 1e8), ("R", "2", 123456789.12345), ("A", "1", 0.00001), ("A", "1", None)]
    df = spark.createDataFrame(rows, "pharmacy_type string, ndc string, nadac_per_unit double")
    got = {r.pharmacy_type: r for r in analysis.price_by_pharmacy_type(df).collect()}
    assert got["R"].avg_nadac_per_unit == round((3e8 + 1e8 + 123456789.12345) / 3, 4)
    assert got["R"].median_nadac == 123456789.1235 and got["A"].price_observations == 1
    large = spark.createDataFrame([(2e18,)], "x double")
    with pytest.raises(PySparkException, match="too large for an exact sum"):
        large.agg(exact_sum("x")).collect()
    many = spark.range(3_000).select(F.lit(9e17).alias("x"))
    assert many.agg(exact_sum("x")).first()[0] == pytest.approx(2.7e21)
    billions = spark.range(200).select(F.lit("9" * 27 + "." + "9" * 10).cast("decimal(37,10)").alias("x"))
    with pytest.raises(PySparkException, match="overflow in an exact sum|out of range|OUT_OF_RANGE|overflow"):
        billions.agg(exact_total(F.col("x"))).collect()


def test_quantile_of_counted_values(spark, partitions):
    rng = random.Random(9)
    pairs = [(rng.choice(["a", "b", None]), rng.choice([-5.5, 0.0, 1e9, *range(500)]) * 1.0, rng.randrange(0, 4)) for _ in range(3_000)]
    expected = {}
    for g in ("a", "b", None):
        values = sorted(v for k, v, n in pairs if k == g for _ in range(n))
        for q in (0.0, 0.5, 0.75):
            expected[g, q] = values[max(0, -(-int(q * 100) * len(values) // 100) - 1)]

    def run(n):
        df = spark.createDataFrame(pairs, "g string, v double, n int").repartition(n)
        return {
            (r.g, q): r.v for q in (0.0, 0.5, 0.75)
            for r in exact_quantile(df, ["g"], "v", q, slices=8, few=20, count="n").collect()
        }

    for result in partitions(run, (3, 40)):
        assert result == expected


def test_price_report_reads_prices_once(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("ARN"), str(rng.randrange(9)), rng.randrange(30_000) / 100) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "pharmacy_type string, ndc string, nadac_per_unit double").repartition(3)
    df.write.parquet(str(tmp_path / "prices"))
    read = tmp_path / "reads"
    read.mkdir()

    def noted(batches):
        from uuid import uuid4

        (read / uuid4().hex).write_text("")
        yield from batches

    prices_ = spark.read.parquet(str(tmp_path / "prices"))
    analysis.price_by_pharmacy_type(prices_.coalesce(1).mapInArrow(noted, prices_.schema)).collect()
    assert len(list(read.iterdir())) == 1


def test_fill_summary_hashes_and_counts_years_far_apart(spark):
    shape = (
        "beneficiary_id string, ndc string, total_rx_cost double, patient_pay_amount double, "
        "payer_paid_amount double, days_supply int, service_date date, service_year int"
    )
    years = [1980, 2043, 2043, 2044, 1979, 1, 9999, 1979, None, 2000]
    rows = [("a", f"n{i % 3}", 0.1, 1e6, None, 30, y and date(y, 1, 1), y) for i, y in enumerate(years)]
    rows += [("b", None, 3e17, 0.3, 1.0, None, None, None), ("c", "n1", 0.0, 0.0, 0.0, 0, date(5, 1, 1), 5)]
    summary = gold.patient_fill_summary(spark.createDataFrame(rows, shape))
    got = {r.beneficiary_id: r for r in summary.collect()}
    assert [got[k].active_years for k in "abc"] == [7, 0, 1]
    assert [got[k].unique_drugs for k in "abc"] == [3, 0, 1]
    assert [got[k].total_rx_fills for k in "abc"] == [10, 1, 1]
    assert [got[k].total_rx_spend for k in "abc"] == [1.0, 3e17, 0.0]
    assert got["a"].total_payer_paid is None and got["a"].total_patient_pay == 1e7
    assert got["a"].avg_days_supply == 30.0 and got["b"].avg_days_supply is None and got["a"].total_days_supply == 300
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan


def test_exact_sums_without_decimals_and_the_same(spark, ansi):
    rng = random.Random(8)
    odd = [0.0, 5e-11, 4.9e-11, 131072.33, 199999.99, 200000.01, -1048576.5, 9.99e17, -9.99e17, 1 / 3, None]
    made = [rng.choice([round(v, 2), v, round(v, 2) - round(v / 3, 2)]) for m in (1, 1e4, 3e5, 1e9, 1e17) for v in [rng.uniform(-m, m) for _ in range(400)]]
    df = spark.createDataFrame([(i % 300, v) for i, v in enumerate(odd + made)], "g int, x double")
    both = df.groupBy("g").agg(exact_sum("x").alias("new"), exact_total(exact("x")).alias("old"))
    assert both.filter("NOT (new <=> old)").count() == 0
    parts = df.groupBy("g", F.rand(3) > 0.5).agg(exact_part("x").alias("p")).groupBy("g").agg(exact_sum_of_parts("p").alias("merged"))
    assert both.join(parts, "g").filter("NOT (new <=> merged)").count() == 0
    sums = df.groupBy("g").agg(exact_sum("x"))._jdf.queryExecution().sparkPlan().toString()
    assert "sum(CASE" in sums and "partial_sum(decimal" not in sums and sums.count("try_sum(") > 0
    for large in (1e18, float("nan"), float("-inf")):
        with pytest.raises(PySparkException, match="too large for an exact sum"):
            spark.createDataFrame([(large,)], "x double").agg(exact_part("x").alias("p")).agg(exact_sum_of_parts("p")).collect()


def test_code_is_cleaned_once_per_row(spark):
    """Patterns run for bare digits only, and the cleaning of a text is not repeated in the plan's code."""
    df = spark.createDataFrame([("0002-1433-01",)], "raw string").repartition(1).select(normalize_code(F.col("raw")).alias("ndc"))
    assert "regexp_replace" not in df._jdf.queryExecution().executedPlan().toString()


def test_gold_inventory_writes_nothing_and_reads_no_amounts(spark):
    """Fills, prices and utilization were written whole, and a quantile of all spending sought, to count rows."""
    counted = registry.queries()["gold_inventory"](spark, "/root/testdata/sf0.001")
    scans = counted._jdf.queryExecution().executedPlan().toString()
    assert "rxlake-" not in scans and "l_shipdate" in scans
    assert "l_extendedprice" not in scans and "l_discount" not in scans
    assert counted.count() == 4


def test_latest_price_with_ties_and_without_dates(spark):
    shape = "ndc string, nadac_per_unit double, pricing_unit string, pharmacy_type string, rate_classification string, effective_date date"
    old, new = date(2020, 1, 1), date(2021, 1, 1)
    rows = [("a", 2.0, "EA", None, "B", new), ("a", 1.0, "ML", "A", "B", new), ("a", None, "ML", "A", "B", old), ("a", 0.5, "ML", "A", "B", None)]
    rows += [("b", 3.0, "EA", "R", "G", None), ("b", None, None, None, None, None), ("c", 4.0, None, None, None, new), ("c", None, "EA", None, None, new)]
    got = {r.ndc: r for r in gold.latest_price(spark.createDataFrame(rows, shape)).collect()}
    assert (got["a"].nadac_per_unit, got["a"].pricing_unit, got["a"].nadac_effective_date) == (1.0, "ML", new)
    assert got["b"].nadac_per_unit is None and got["b"].pharmacy_type is None
    assert (got["c"].nadac_per_unit, got["c"].pricing_unit, got["c"].nadac_effective_date) == (None, "EA", new)


def test_price_scan_is_small_enough_to_be_compiled(spark):
    """The JVM never compiles a method of more than 8,000 bytes of bytecode; this one had 8,038."""
    inputs = driver_tables.Inputs(spark, "/root/testdata/sf0.001")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (inputs.pricing(), inputs.anomaly_features(), gold.monthly_prices(inputs.pricing()), inputs.fills()):
            stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
            assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_raw_code_in_every_format(spark):
    rows = spark.range(123456784, 123456792).selectExpr("id", f"{driver_tables.raw_code('id')} AS raw").collect()
    got = {r.id % 8: r.raw.replace(str(r.id)[-4:], "dddd") for r in rows}
    assert got == {
        0: "2345-dddd-01", 1: "23456-785-01", 2: "12345-dddd-1", 3: "  12345-dddd-01 ",
        4: "12345dddd01", 5: "12345dddd1", 6: "12345dddd", 7: "UNK12345dddd",
    }
