import random

import pytest
from pyspark.sql import functions as F

from rxlake.functions.columns import exact_avg, exact_sum
from rxlake.functions.states import STATE_CODES, state_lookup
from rxlake.operators import analysis, prices, quality
from rxlake.operators.gold import HIGH_COST, STANDARD
from rxlake.operators.keyed import ntile_of_rank, with_global_rank


@pytest.mark.parametrize("rows,n", [(1, 4), (3, 4), (4, 4), (10, 4), (103, 4), (50, 7)])
def test_ntile_matches_the_window_function(spark, rows, n):
    rng = random.Random(rows)
    data = [(f"{i:04d}", float(rng.choice([1, 1, 1, 2, 3]))) for i in range(rows)]
    df = spark.createDataFrame(data, "id string, x double").repartition(3)
    ranked = with_global_rank(df, [F.col("x").asc(), F.col("id").asc()])
    got = {r["id"]: (r["_rank"], r["q"]) for r in
           ranked.withColumn("q", ntile_of_rank(n)).collect()}
    ordered = sorted(data, key=lambda r: (r[1], r[0]))
    size, longer = divmod(rows, n)
    groups = [q for q in range(1, n + 1) for _ in range(size + (q <= longer))]
    assert got == {r[0]: (i + 1, groups[i]) for i, r in enumerate(ordered)}


def test_exact_sum_does_not_depend_on_order(spark, partitions):
    rng = random.Random(1)
    cents = [rng.randrange(10**9) for _ in range(2000)]
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    results = partitions(
        lambda n: df.repartition(n).agg(exact_sum("x"), exact_avg("x")).first()
    )
    assert all(tuple(r) == (sum(cents) / 100, sum(cents) / 100 / 2000) for r in results)


def test_exact_avg_of_nothing(spark):
    row = spark.createDataFrame([(None,)], "x double").agg(exact_avg("x").alias("a")).first()
    assert row["a"] is None


@pytest.fixture
def use(spark):
    rows = [
        ("a", 0.4, 1, 0, 3, 2, 1, 10.0, 1.0),
        ("b", 0.8, 1, 0, 9, 3, 2, 20.0, 2.0),
        ("c", 0.5, 0, 0, 9, 1, 1, 30.0, 3.0),
        ("d", None, 1, 0, 9, 1, 1, 40.0, 4.0),
        ("e", 0.1, 0, 0, 2, 1, 1, 50.0, 5.0),
    ]
    df = spark.createDataFrame(
        rows,
        "beneficiary_id string, days_supply_coverage_ratio double, cc_diabetes int, "
        "cc_cancer int, total_rx_fills int, unique_drugs int, chronic_condition_count int, "
        "total_rx_spend double, total_medical_spend double",
    )
    return df


def test_adherence_by_condition(use, by_key):
    rows = by_key(
        analysis.adherence_by_condition(use, {"cc_diabetes": "Diabetes", "cc_cancer": "Cancer"}),
        "condition",
    )
    d = rows["Diabetes"]
    assert d["with_condition"] == pytest.approx(0.6) and d["n_with"] == 2
    assert d["without_condition"] == pytest.approx(0.3) and d["delta"] == pytest.approx(0.3)
    c = rows["Cancer"]  # nobody has it: counted as 0
    assert c["with_condition"] == 0.0 and c["n_with"] == 0


def test_low_adherence(use):
    row = analysis.low_adherence_cohort(use).first()
    assert row["low_adherence_count"] == 1 and row["total_count"] == 4
    assert row["low_adherence_pct"] == 25.0 and row["avg_total_rx_spend"] == 10.0


def test_burden(use):
    rows = analysis.adherence_by_burden(use).collect()
    assert [(r["chronic_condition_count"], r["beneficiary_count"]) for r in rows] == [(1, 3), (2, 1)]


def test_states(spark, by_key):
    patients = spark.createDataFrame(
        [("05", 1), ("05", 2), ("33", 1), ("A5", 1), ("56", 1), ("99", 1), ("ZZ", 1)],
        "state_code string, chronic_condition_count int",
    )
    rows = by_key(analysis.patients_by_state(patients, state_lookup(spark)), "state_code")
    assert {k: r["fips_state"] for k, r in rows.items()} == {
        "05": "06", "33": "36", "A5": "28", "56": "CA", "99": None, "ZZ": None,
    }
    assert rows["05"]["beneficiary_count"] == 2 and rows["05"]["avg_chronic_conditions"] == 1.5
    assert len(STATE_CODES) == 108


def test_pivot_and_types(spark, by_key):
    pricing = spark.createDataFrame(
        [("A", "C", 1.0), ("A", "I", 3.0), ("A", None, 50.0), ("B", None, 9.0), ("D", "Z", 2.0)],
        "ndc string, pharmacy_type string, nadac_per_unit double",
    )
    want = {
        "A": {"ndc": "A", "C": 1.0, "I": 3.0, "Z": None},
        "D": {"ndc": "D", "C": None, "I": None, "Z": 2.0},
    }
    assert by_key(analysis.price_pivot(pricing), "ndc") == want
    assert by_key(analysis.price_pivot(pricing, ["C", "I", "Z"]), "ndc") == want
    by_type = by_key(analysis.price_by_pharmacy_type(pricing), "pharmacy_type")
    assert set(by_type) == {"C", "I", "Z"} and by_type["C"]["stddev_nadac"] is None


@pytest.fixture
def cohort(spark):
    rows = [
        (f"{i:02d}", HIGH_COST if i < 6 else STANDARD, float(i), i % 2, 10.0 * i, i, 5.0, 1)
        for i in range(9)
    ]
    return spark.createDataFrame(
        rows,
        "beneficiary_id string, spend_tier string, total_rx_spend double, inpatient_claims int, "
        "inpatient_total_paid double, outpatient_claims int, outpatient_total_paid double, "
        "chronic_condition_count int",
    )


def test_quartiles(cohort):
    rows = analysis.spend_quartiles(cohort).collect()
    assert [(r["rx_quartile"], r["n"], r["avg_rx_spend"]) for r in rows] == [
        (1, 2, 0.5), (2, 2, 2.5), (3, 1, 4.0), (4, 1, 5.0),
    ]


def test_spend_ratio(cohort, by_key):
    rows = by_key(analysis.spend_ratio(cohort), "spend_tier")
    assert rows[HIGH_COST]["ip_cost_per_rx_dollar"] == 10.0
    assert rows[HIGH_COST]["op_cost_per_rx_dollar"] == pytest.approx(25 / 15, abs=1e-3)


def test_thin_margin(spark):
    journey = spark.createDataFrame(
        [("A", "G", 5.0, 10), ("B", "G", 1.0, 9), ("C", "G", 2.0, 11), ("D", "B", 0.0, 99),
         ("E", "G", None, 99)],
        "ndc string, rate_classification string, acquisition_to_claim_spread double, "
        "total_claims int",
    ).selectExpr("*", "'g' generic_name", "'l' labeler_name", "1 unique_patients",
                 "1D nadac_per_unit", "1D cost_per_unit_on_claim", "1D patient_cost_share_pct")
    assert [r["ndc"] for r in analysis.thin_margin_generics(journey).collect()] == ["C", "A"]


def test_price_features(spark, by_key):
    def history(ndc, *values):
        return [(ndc, v, f"2024-01-{i + 1:02d}") for i, v in enumerate(values)]

    data = (
        history("three", 1.0, 2.0, 3.0) + history("four", 1.0, 2.0, 3.0, 4.0)
        + history("flat", *[0.1] * 8) + history("jump", *[1.0, 1.1] * 5, 9.0)
        + history("zero", 1.0, 1.0, 1.0, 1.0, 0.0)
    )
    pricing = spark.createDataFrame(data, "ndc string, nadac_per_unit double, d string").selectExpr(
        "ndc", "nadac_per_unit", "to_date(d) effective_date", "'G' rate_classification"
    )
    rows = by_key(prices.price_anomaly_features(pricing), "ndc")
    assert set(rows) == {"four", "flat", "jump", "zero"}
    assert rows["four"]["mean_price"] == 2.5 and rows["four"]["median_price"] == 2.0
    assert rows["four"]["latest_deviation"] == pytest.approx(0.6)
    assert rows["flat"]["price_stddev"] == 0.0 and rows["flat"]["latest_z_score"] is None
    # a zero price is no history, but may be the latest price
    assert rows["zero"]["price_observations"] == 4 and rows["zero"]["latest_price"] == 0.0
    dim = spark.createDataFrame(
        [("jump", None, "b" * 40, "l")],
        "ndc string, generic_name string, brand_name string, labeler_name string",
    )
    far = prices.z_score_anomalies(prices.price_anomaly_features(pricing), dim).collect()
    assert [(r["ndc"], r["drug_name"], r["direction"]) for r in far] == [
        ("jump", "b" * 28, "PRICE UP")
    ]


def test_quality_report(spark, by_key):
    df = spark.createDataFrame(
        [(1, "a", 0.0), (1, None, -0.0), (2, None, 1.0), (3, None, None)],
        "i int, s string, x double",
    )
    rows = by_key(quality.quality_report(df), "column_name")
    assert {k: (r["total_rows"], r["null_pct"], r["distinct_values"], r["flag"])
            for k, r in rows.items()} == {
        "i": (4, 0.0, 3, 0), "s": (4, 75.0, 2, 1), "x": (4, 25.0, 3, 0),
    }
    nulls = by_key(quality.null_rates(df), "column_name")
    assert nulls["s"]["flag"] == 1 and nulls["x"]["null_pct"] == 25.0 and nulls["x"]["flag"] == 1


def test_quality_report_keeps_types_apart(spark, by_key):
    df = spark.sql("""
        SELECT * FROM VALUES
            (DATE'2020-01-01', TIMESTAMP'2020-01-01 00:00:00', 1.10BD, true, 'NaN', double('NaN'), NULL, array(1)),
            (DATE'2020-01-02', TIMESTAMP'2020-01-01 00:00:00.000001', 1.1BD, false, 'nan', double('NaN'), NULL, array(1)),
            (DATE'2020-01-02', NULL, 1.11BD, NULL, 'NaN', double('Infinity'), NULL, NULL)
        AS t(d, t, m, b, s, x, n, `an array`)
    """)
    rows = by_key(quality.quality_report(df.repartition(3)), "column_name")
    assert {k: r["distinct_values"] for k, r in rows.items()} == {
        "d": 2, "t": 3, "m": 2, "b": 3, "s": 2, "x": 2, "n": 1, "an array": 2,
    }
    assert rows["n"]["null_pct"] == 100.0 and rows["n"]["flag"] == 1
    assert quality.quality_report(df.limit(0)).count() == 0
    whole = by_key(quality.quality_report(df.select("d")), "column_name")
    assert (whole["d"]["total_rows"], whole["d"]["distinct_values"]) == (3, 2)


def test_key_checks(spark):
    df = spark.createDataFrame([("1-1-1",), ("00001000101",), ("x",), ("x",), (None,)], "c string")
    dim = spark.createDataFrame([("00001000101",)], "ndc string")
    assert tuple(quality.key_coverage(df, "c", dim).first()) == (4, 2, 50.0, 2)
    assert tuple(quality.normalize_rate(df, "c").first()) == (5, 2, 2 + 1, 40.0)
    assert quality.duplicate_keys(df, ["c"]).first()[0] == 1
    flags = spark.createDataFrame([(1, 0), (0, 0)], "cc_a int, cc_b int")
    assert {tuple(r) for r in quality.flag_prevalence(flags).collect()} == {
        ("cc_a", 50.0), ("cc_b", 0.0)
    }
    rows = quality.table_inventory({"b": dim, "a": df}).collect()
    assert [tuple(r) for r in rows] == [("a", 5), ("b", 1)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "c string")
    assert tuple(quality.normalize_rate(empty, "c").first()) == (0, 0, 0, 0.0)
    assert quality.null_rates(empty).first()["null_pct"] == 0.0
