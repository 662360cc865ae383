import random
from datetime import date, timedelta

import pytest

from rxlake.operators import refills
from rxlake.operators.refills import mean_refill_rate, refill_sequences, refill_stats
from rxlake.sources.scratch import stored

SCHEMA = (
    "beneficiary_id string, pde_id string, service_date date, ndc string, days_supply int, "
    "quantity_dispensed double, patient_pay_amount double, total_rx_cost double"
)
START = date(2009, 1, 1)


def fill(patient, pde, day, ndc, supply):
    when = None if day is None else START + timedelta(days=day)
    return (patient, pde, when, ndc, supply, 1.0, 1.0, 2.0)


def by_hand(rows, grace=1.5):
    """Sequences one fill at a time."""
    groups = {}
    for r in rows:
        if r[4] is not None and r[4] > 0:
            groups.setdefault((r[0], r[3]), []).append(r)
    out = {}
    for fills in groups.values():
        fills.sort(
            key=lambda r: (
                r[2] is not None, r[2] or START, r[4], r[1],
            )
        )
        for n, (before, now) in enumerate(zip(fills, fills[1:]), start=2):
            gap = (now[2] - before[2]).days if now[2] and before[2] else None
            on_time = int(gap is not None and gap <= before[4] * grace)
            out[now[1]] = (before[2], before[4], n, gap, on_time)
    return out


def random_fills(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4  # one pair holds a large part
        rows.append(
            fill(
                "P0" if hot else rng.choice(["P1", "P2", "", None]),
                f"c{i}",
                None if rng.random() < 0.1 else rng.randrange(120 if hot else 400),
                None if hot else rng.choice(["A", "B", "", None]),
                rng.choice([30, 30, 60, 90, 0, None]),
            )
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_sequences_against_brute_force(spark, seed):
    rows = random_fills(seed)
    got = {
        r["pde_id"]: (
            r["prev_fill_date"], r["prev_days_supply"], r["fill_number"],
            r["days_between_fills"], r["refilled_on_time"],
        )
        for r in refill_sequences(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    }
    assert got == by_hand(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_stats_against_brute_force(spark, by_key, seed):
    rows = random_fills(seed)
    steps = by_hand(rows)
    patients = {}
    for r in rows:
        if r[1] in steps:
            patients.setdefault(r[0], []).append((*steps[r[1]], r[4]))
    got = by_key(refill_stats(spark.createDataFrame(rows, SCHEMA).repartition(5)), "beneficiary_id")
    assert set(got) == set(patients)
    for patient, fills in patients.items():
        mine = got[patient]
        gaps = [f[3] for f in fills if f[3] is not None]
        assert mine["total_refill_opportunities"] == len(fills)
        assert mine["on_time_refills"] == sum(f[4] for f in fills)
        assert mine["avg_gap_days"] == pytest.approx(sum(gaps) / len(gaps))
        assert mine["avg_days_supply"] == pytest.approx(sum(f[5] for f in fills) / len(fills))
        assert mine["historical_refill_rate"] == pytest.approx(
            sum(f[4] for f in fills) / len(fills)
        )


def test_gap_of_exactly_the_grace_is_on_time(spark, by_key):
    rows = [fill("P", "a", 0, "A", 30), fill("P", "b", 45, "A", 30), fill("P", "c", 91, "A", 30)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = by_key(refill_sequences(df), "pde_id")
    assert got["b"]["refilled_on_time"] == 1 and got["c"]["refilled_on_time"] == 0
    stats = refill_stats(df).first()
    assert (stats["total_refill_opportunities"], stats["on_time_refills"]) == (2, 1)


def test_single_fills_have_no_stats(spark):
    df = spark.createDataFrame([fill("P", "a", 0, "A", 30), fill("P", "b", 0, "B", 30)], SCHEMA)
    assert refill_stats(df).count() == 0 and refill_sequences(df).count() == 0


def test_unknown_dates_are_late_and_have_no_gap(spark):
    rows = [fill("P", "a", None, "A", 30), fill("P", "b", None, "A", 30)]
    row = refill_stats(spark.createDataFrame(rows, SCHEMA)).first()
    assert row["total_refill_opportunities"] == 1 and row["on_time_refills"] == 0
    assert row["avg_gap_days"] is None


def test_same_for_any_partitioning(spark, partitions):
    df = spark.createDataFrame(random_fills(5), SCHEMA)
    results = partitions(
        lambda n: sorted(map(str, refill_sequences(df.repartition(n)).collect()))
    )
    assert results[0] == results[1] == results[2]


def test_mean_rate(spark):
    rows = [fill("P", "a", 0, "A", 30), fill("P", "b", 10, "A", 30), fill("P", "c", 300, "A", 30)]
    row = mean_refill_rate(refill_stats(spark.createDataFrame(rows, SCHEMA))).first()
    assert row["patients"] == 1 and row["mean_refill_rate"] == 0.5


def test_a_pair_over_many_partitions_with_one_shuffle(spark, monkeypatch):
    rows = [fill("P0", f"c{i:04}", i // 3, "A", 30) for i in range(600)] + random_fills(6, 900)
    rows += [fill(None, f"n{i:04}", None, None, 30) for i in range(200)]
    seen = []

    def kept(df, name):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(refills, "stored", kept)
    for name, value in (("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.shuffle.partitions", "12")):
        spark.conf.set(name, value)
    try:
        df = refill_sequences(spark.createDataFrame(rows, SCHEMA))
        got = {
            r["pde_id"]: (r["prev_fill_date"], r["prev_days_supply"], r["fill_number"], r["days_between_fills"], r["refilled_on_time"])
            for r in df.collect()
        }
        hot = df.filter("beneficiary_id = 'P0' AND ndc = 'A'").inputFiles()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == by_hand(rows)
    assert len(seen) == 1 and seen[0].count("Exchange") == seen[0].count("rangepartitioning") == 1
    assert len(hot) >= 6


def test_fills_without_a_predecessor_are_not_stored_once_more(spark, monkeypatch):
    rows = [fill(f"Q{i:04}", f"s{i}", 0, "A", 30) for i in range(900)] + random_fills(7, 60)
    rows += [fill("Q0500", "again", 20, "A", 30), fill("Q0899", "last", 20, "A", 30)]
    many = []

    def kept(df, name):
        found = stored(df, name)
        many.append(found.count())
        return found

    monkeypatch.setattr(refills, "stored", kept)
    got = {
        r["pde_id"]: (r["prev_fill_date"], r["prev_days_supply"], r["fill_number"], r["days_between_fills"], r["refilled_on_time"])
        for r in refill_sequences(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    }
    wanted = by_hand(rows)
    assert got == wanted
    # A partition has its first pair's rows and a batch's last row besides.
    assert len(many) == 1 and many[0] <= len(wanted) + 50
